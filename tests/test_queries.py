"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from docloom.plans import queries
from tests.conftest import DATA

QUERIES = queries.QUERIES
CHECKS = queries.CHECKS


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(DATA):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{name}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    cursor = database.execute(CHECKS[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    wanted = sorted(tuple(plain(row[names.index(c)]) for c in columns) for row in cursor.fetchall())
    assert got == wanted
    assert got


def test_every_query_has_sql():
    assert set(CHECKS) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert CHECKS.items() <= entry_points.oracle_sql().items()


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["doc_id", "body"]
    assert df.count() > 0
