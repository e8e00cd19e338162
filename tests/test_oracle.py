"""Every query with checking SQL against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_values_match(spark, small, con, name):
    assert compare(entry.queries()[name](spark, small), con, SQL[name]) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(entry.queries())
