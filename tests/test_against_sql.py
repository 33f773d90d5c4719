"""Every registered query against its SQL twin on the smallest test tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fleetlens.catalog import QUERIES, SQL, STREAM_QUERIES, STREAM_SQL

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
STREAMS = sorted(STREAM_QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "NULL"
    return repr(float(value)) if isinstance(value, float) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", [*sorted(QUERIES), *STREAMS])
def test_same_rows_as_sql(spark, sql, name):
    mine = queries()[name](spark, DATA)
    theirs = sql.execute(oracle_sql()[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(mine.columns) == sorted(columns)
    assert _rows(mine.columns, mine.collect()) == _rows(columns, theirs.fetchall())


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL) and set(STREAM_QUERIES) == set(STREAM_SQL)


def test_entry(spark):
    assert entry(spark).columns == ["sensor_id", "ts", "mean", "window_start", "window_end"]
