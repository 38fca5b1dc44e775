"""Near duplicates among vectors by p-stable hashing, checked by exact cosines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import ship_code, stored, table, task_count, valid_vectors
from narrowlake.llm.components import components

# Width of a bucket of one projection, in units of the vectors' length.
WIDTH = 2.0
# Share of the pairs exactly at the threshold that meet in at least one table.
RECALL = 0.95
# Members of one bucket that are compared in one place; larger buckets are cut into tiles.
BUCKET_ROWS = 1_024
# Rows of many buckets that one call compares.
CALL_ROWS = 60_000


def same_cell(distance: float, width: float) -> float:
    """Chance that two points so far apart fall into one cell of a random projection."""
    t = width / distance
    below = 0.5 * (1 + math.erf(-t / math.sqrt(2)))
    return 1 - 2 * below - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def tables_for(rows: int, threshold: float) -> tuple[int, int]:
    """Projections of a table and number of tables for so many vectors.

    Projections are added until an unrelated vector (at a right angle) shares a bucket
    with about one other; tables are added until pairs at the threshold meet with RECALL.
    """
    apart = same_cell(math.sqrt(2), WIDTH)
    near = same_cell(math.sqrt(2 - 2 * threshold), WIDTH)
    projections = max(6, math.ceil(math.log(max(rows, 2)) / -math.log(apart)))
    return projections, math.ceil(math.log(1 - RECALL) / math.log1p(-(near**projections)))


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector: str = "embedding", seed: int = 11
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of the table.

    Equal vectors are one class with a weight.  Class vectors are scaled to length one,
    projected on normal directions, shifted, cut into cells of WIDTH; the cells of a
    table's projections name a bucket.  Only int8 codes of the vectors travel with the
    buckets: inside a bucket their products, with the codes' own error as a margin, drop
    pairs that can not reach the threshold.  The distinct rest is joined with the vectors
    and checked by cosine in double precision.  Buckets above BUCKET_ROWS are cut into
    tiles of member groups, so none is too large for a task and none is cut short.

    n_links counts the other rows at or above the threshold, copies included; component_id
    is the smallest id that links reach, kept marks it.  Vectors that are null, empty,
    zero or hold null or non-finite components link with nothing, nor do vectors of
    different length.  Rows that share an id are one vertex each with that id.  A null id
    takes part in nothing and comes back with a null component and kept = true.  Other
    columns are ignored; an empty table gives an empty result.
    """
    ship_code(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    usable = F.col("id").isNotNull() & valid_vectors("vector")
    rows = rows.withColumns(
        {
            "h1": F.when(usable, F.xxhash64("vector")),
            "h2": F.when(usable, F.xxhash64(F.lit(seed), "vector")),
        }
    )
    classes = stored(
        rows.where("h1 IS NOT NULL")
        .groupBy("h1", "h2", "vector")
        .agg(F.min("id").alias("rep"), F.count("*").alias("weight")),
        "vectors",
    )
    found = _pairs(classes, threshold, seed)
    links = stored(_checked(found, classes, threshold), "vector-links")
    both = links.select("a", "wb").union(links.select(F.col("b").alias("a"), F.col("wa").alias("wb")))
    linked = both.groupBy(F.col("a").alias("rep")).agg(F.sum("wb").alias("others"))
    grouped = components(links.select("a", "b")).select(F.col("id").alias("rep"), "component")
    classes = (
        classes.select("h1", "h2", "rep", "weight").join(linked, "rep", "left").join(grouped, "rep", "left")
    )
    out = rows.select("id", "h1", "h2").join(classes, ["h1", "h2"], "left")
    component = F.when(F.col("h1").isNull(), F.col("id")).otherwise(F.coalesce("component", "rep"))
    return out.select(
        F.col("id").alias("vec_id"),
        F.when(F.col("h1").isNull(), F.lit(0)).otherwise(F.coalesce("others", F.lit(0)) + F.col("weight") - 1)
        .cast("long")
        .alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def _pairs(classes: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Distinct pairs (a < b) of class ids that share a bucket and may reach the threshold."""
    spark = classes.sparkSession
    rows = classes.count()
    projections, tables = tables_for(rows, threshold)

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, own in batch.groupby(batch["vector"].map(len)):
                yield from _buckets(own, projections, tables, seed)

    buckets = classes.select("rep", "vector").mapInPandas(
        hashed, "bucket long, id long, code binary, wide float"
    )
    counted = buckets.withColumn(
        "members", F.expr("count(*) OVER (PARTITION BY bucket)")
    ).where("members > 1")
    groups = F.ceil(F.col("members") / BUCKET_ROWS).cast("int")
    cut = counted.withColumn("n", groups).withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int"))
    tiles = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        F.when(F.col("own") != F.col("other"), F.col("own")).otherwise(-1).alias("side"),
        "id",
        "code",
        "wide",
    )
    calls = task_count(rows * tables, CALL_ROWS, spark.sparkContext.defaultParallelism)

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        return _compare(rows, threshold)

    found = tiles.groupBy(F.pmod("tile", F.lit(calls)).alias("call")).applyInPandas(compared, "a long, b long")
    return found.distinct()


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: close inputs give unrelated outputs."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _buckets(rows: pd.DataFrame, projections: int, tables: int, seed: int) -> Iterator[pd.DataFrame]:
    x = np.stack(rows["vector"].to_numpy())
    x = x / np.abs(x).max(1, keepdims=True)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    dims = x.shape[1]
    rng = np.random.default_rng([seed, dims])
    codes = np.rint(x * 127)
    wide = np.sqrt(((x - codes / 127) ** 2).sum(1)).astype(np.float32) * np.float32(1.0001)
    blobs = [c.tobytes() for c in codes.astype(np.int8)]
    ids = rows["rep"].to_numpy()
    factors = rng.integers(1, 2**63, projections, dtype=np.uint64) | np.uint64(1)
    for t in range(tables):
        directions = rng.standard_normal((dims, projections))
        cells = np.floor((x @ directions + rng.uniform(0, WIDTH, projections)) / WIDTH).astype(np.int64)
        key = _mixed((cells.astype(np.uint64) * factors).sum(1, dtype=np.uint64) + np.uint64(t * 1_000_003 + dims))
        yield pd.DataFrame({"bucket": key.view(np.int64), "id": ids, "code": blobs, "wide": wide})


def _compare(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Pairs within each tile whose codes allow the threshold, each once for this call."""
    rows = rows.iloc[np.lexsort((rows["id"].to_numpy(), rows["tile"].to_numpy()))]
    tile, side, ids = (rows[c].to_numpy() for c in ("tile", "side", "id"))
    wide, sizes = rows["wide"].to_numpy().astype(np.float64), rows["code"].map(len).to_numpy()
    out = [np.empty((0, 2), np.int64)]
    for dims in np.unique(sizes):
        own = np.nonzero(sizes == dims)[0]
        codes = np.frombuffer(b"".join(rows["code"].to_numpy()[own]), np.int8).reshape(len(own), dims).astype(np.float32)
        t, s, i, w = tile[own], side[own], ids[own], wide[own]
        left, shift = np.arange(len(own)), 0
        while len(left):
            shift += 1
            left = left[left + shift < len(own)]
            left = left[t[left] == t[left + shift]]
            some = left[((s[left] == -1) | (s[left] != s[left + shift])) & (i[left] != i[left + shift])]
            for at in range(0, len(some), 50_000):
                a = some[at : at + 50_000]
                b = a + shift
                product = np.einsum("ij,ij->i", codes[a], codes[b]).astype(np.float64) / (127 * 127)
                ok = product + w[a] + (1 + w[a]) * w[b] >= threshold - 1e-4
                if ok.any():
                    pair = np.stack([i[a[ok]], i[b[ok]]], 1)
                    out.append(np.sort(pair, 1))
    found = np.unique(np.concatenate(out), axis=0)
    return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})


def _checked(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose cosine in double precision reaches the threshold, with both weights."""

    def cosine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for at in range(0, len(rows), 50_000):
                part = rows.iloc[at : at + 50_000]
                part = part[part["va"].map(len).to_numpy() == part["vb"].map(len).to_numpy()]
                for _, own in part.groupby(part["va"].map(len)):
                    a, b = np.stack(own["va"].to_numpy()), np.stack(own["vb"].to_numpy())
                    a, b = (v / np.abs(v).max(1, keepdims=True) for v in (a, b))
                    product = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
                    yield own[product >= threshold][["a", "b", "wa", "wb"]]

    left = classes.select(F.col("rep").alias("a"), F.col("vector").alias("va"), F.col("weight").alias("wa"))
    right = classes.select(F.col("rep").alias("b"), F.col("vector").alias("vb"), F.col("weight").alias("wb"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(cosine, "a long, b long, wa long, wb long")


def op1_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "embeddings"))


SQL = """
WITH RECURSIVE points AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM points p JOIN points q
    ON p.vec_id <> q.vec_id AND len(p.v) = len(q.v) AND list_cosine_similarity(p.v, q.v) >= 0.9
), reach AS (
  SELECT a AS id, b AS other FROM links
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), firsts AS (
  SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id
), counts AS (
  SELECT a AS id, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links,
       coalesce(component, e.vec_id) AS component_id,
       coalesce(component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN firsts f ON e.vec_id = f.id LEFT JOIN counts c ON e.vec_id = c.id
"""
