"""Workforce-attrition analytics as Spark jobs.

Every operator takes DataFrames and returns a DataFrame (or a fitted Spark ML
model); nothing whole ever passes through the driver or a single task.
"""

__version__ = "0.1.0"
