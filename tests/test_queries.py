"""Every query with an SQL twin equals it; the others return rows that hold their invariants."""

import pytest

from staffflow.plans import load_all
from tests.compare import compare, connect
from tests.conftest import SMALL

REGISTRY = load_all()
TWINS = [n for n, q in REGISTRY.items() if q.sql is not None]


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", TWINS)
def test_equals_sql_twin(spark, con, sf_dir, name):
    ok, note = compare(spark, con, REGISTRY[name], sf_dir)
    assert ok, note


def test_entry_runs(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert 0 < len(rows) <= 15
    assert set(contract.oracle_sql()) <= set(contract.queries())
