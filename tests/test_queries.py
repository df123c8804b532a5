"""Every registered query against its SQL, on the smallest given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import register_tables, rows_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    register_tables(con, SMALL)
    return con


def test_every_query_has_its_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_its_sql(spark, tables, name):
    df = entry.queries()[name](spark, SMALL)
    cursor = tables.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    got = rows_of(df.columns, df.collect())
    assert got == rows_of(columns, cursor.fetchall())


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
