"""Every registered query against its SQL, on the smallest driver tables."""

import math
import os

import duckdb
import pytest

from sessionlab.catalog import load_queries, load_sql

FOLDER = "/root/testdata/sf0.001"
TABLES = ("events", "customer", "nation")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")

QUERIES, SQL = load_queries(), load_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(plain(row[i]) for i in order) for row in values)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    frame = QUERIES[name](spark, FOLDER)
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = database.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert got == rows(columns, cursor.fetchall())
