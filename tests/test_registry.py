"""Every registered query against its SQL, over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def database(small):
    connection = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value) if isinstance(value, float) else str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(comparable(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, small, database, name):
    df = QUERIES[name](spark, small)
    found = sorted_rows(df.columns, df.collect())
    cursor = database.execute(SQL[name])
    expected = sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    assert found == expected


def test_entry_has_rows(spark):
    df = entry_point.entry(spark)
    assert df.count() == 6000 and df.filter("price is null or quantity is null").count() == 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
