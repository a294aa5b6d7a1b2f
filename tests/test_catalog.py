"""Every registered query against the same query in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__
from laborscope.catalog import QUERIES, SQL

TYPES = {"bigint": "int64", "int": "int32", "string": "string", "double": "double", "boolean": "bool"}


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for file in os.listdir(folder):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return connection


def rows(table, columns):
    """Sorted rows, with doubles to 12 digits because sums may be in another order."""
    def cell(x):
        if x is None or x != x:
            return "null"
        return f"{x:.12g}" if isinstance(x, float) else str(x)

    return sorted(tuple(cell(r[c]) for c in columns) for r in table)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    result = QUERIES[name](spark, folder)
    expected = database.sql(SQL[name]).to_arrow_table()
    assert {c: TYPES[t] for c, t in result.dtypes} == {
        f.name: str(f.type).replace("large_", "") for f in expected.schema
    }
    columns = sorted(result.columns)
    got = rows((r.asDict() for r in result.collect()), columns)
    assert got == rows(expected.to_pylist(), columns)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 10
