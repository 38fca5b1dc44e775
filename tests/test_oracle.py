"""Every query against its SQL on the same tables."""

import collections
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from narrowlake.registry import QUERIES
from oracles import ORACLES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], collections.Counter(
        tuple(row[i] for i in order) for row in rows
    )


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    got_columns, got = as_bag(frame.columns, [tuple(r) for r in frame.collect()])
    result = duck.execute(ORACLES[name])
    want_columns, want = as_bag([d[0] for d in result.description], result.fetchall())
    assert got_columns == want_columns
    assert got == want, (
        f"only Spark: {list((got - want).items())[:3]}, only SQL: {list((want - got).items())[:3]}"
    )
    assert want


def test_entry(spark):
    assert entry_point.entry(spark).columns[:4] == ["seriesid", "aod", "rssdid", "submission_ts"]
    assert entry_point.entry(spark).count() > 0
