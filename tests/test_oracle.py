"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from fundtide import catalog
from tools.compare import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# Optional subpackages have tests of their own.
QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_is_lazy_and_not_empty(spark):
    frame = entry.entry(spark)
    assert frame.count() > 0
    assert frame.columns[:2] == ["as_of_date", "etf_ticker"]


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_as_sql(spark, con, key):
    state, _, _ = compare(spark, con, SF_DIR, key, QUERIES, ORACLES)
    assert state == "ok"
