"""Every registered query that has a SQL statement, compared row by row with DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "state_name"


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_duckdb(spark, sf_dir, con, name):
    assert differences(entry.queries()[name](spark, sf_dir), con, SQL[name]) == ""
