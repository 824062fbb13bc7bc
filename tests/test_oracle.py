"""Every registered query against its SQL on the smallest test tables, with compiled stages."""

import os

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    """Operators that SQL cannot express have tests of their own, all others have SQL."""
    assert set(oracle_sql()) <= set(queries())
    assert not [q for q in set(queries()) - set(oracle_sql()) if not q.startswith("op") and q != "pipeline"]


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    mine = check.rows_of(df.columns, df.collect())
    expected = duck.sql(oracle_sql()[name])
    assert mine == check.rows_of(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
