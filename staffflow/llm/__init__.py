"""Operators for preparing training text: scoring, deduplication, filters, tokens, mixing.

Nothing else in the library imports this package. Each operator is a module with a function
from DataFrames to a DataFrame; ``queries`` holds the registered queries over the given tables.
"""

import sys

from pyspark import cloudpickle

# task functions travel with the job: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
