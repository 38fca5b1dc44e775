"""Queries that SQL can express against it, on the tables the driver uses."""

import duckdb
import pytest

from narrowlake.llm import queries

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = con.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    want = sorted(result.fetchall())
    frame = queries.QUERIES[name](spark, FOLDER).select(*names)
    assert sorted(tuple(r) for r in frame.collect()) == want and want
