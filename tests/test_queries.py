"""Every named query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from check import assert_same, connect
from millrace.plans import catalog

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, sf, con, name):
    assert_same(QUERIES[name](spark, sf), con, ORACLES[name])


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["window_end", "rank", "item", "ct"]


def test_names():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)
