"""Every registered query against its SQL in DuckDB, on the small tables."""

import pytest

import __spark_entry__ as entry
from check import compare, connect
from haulwatch.plans.oracles import ORACLES
from haulwatch.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, small, name):
    assert compare(spark, con, small, name) is None


def test_entry(spark):
    assert entry.entry(spark).columns
