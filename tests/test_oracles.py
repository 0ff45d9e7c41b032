"""Every registered query against DuckDB on the same files."""

import math
import os
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from tallyrill.catalog import batch_queries, stream_queries
from tallyrill.catalog.oracles import ORACLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cleaned = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(cleaned, key=repr)


def _plain(value):
    if isinstance(value, float) and not math.isnan(value):
        return round(value, 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got = queries()[name](spark, SF)
    want = duck.execute(oracle_sql()[name])
    columns = {d[0]: str(d[1]) for d in want.description}
    assert {n: TYPES[t] for n, t in got.dtypes} == columns
    expected = want.fetchall()
    assert _rows(got.columns, got.collect()) == _rows(list(columns), expected)


def test_every_query_has_sql():
    own = {**batch_queries.QUERIES, **stream_queries.QUERIES}
    assert set(own) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(stream_queries.QUERIES))
def test_streams_do_not_depend_on_where_batches_are_cut(spark, duck, monkeypatch, name):
    feed = stream_queries._feed

    def in_many_files(job, ev):
        feed(job, ev.repartition(4, F.xxhash64("event_id")))

    monkeypatch.setattr(stream_queries, "_feed", in_many_files)
    monkeypatch.setattr(stream_queries, "BATCH_BYTES", "1")
    got = queries()[name](spark, SF)
    want = duck.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert _rows(got.columns, got.collect()) == _rows(names, want.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0
