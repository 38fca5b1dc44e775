"""Nearest neighbours by a block matrix join over int8 tiles."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import ship_code, stored, table, task_count, valid_vectors

# Rows of one tile: with 64 components a tile's codes take 4 MB and 0.25 MB.
TILE_ROWS = 65_536
TILE_QUERIES = 2_048
# Float32 products of int8 codes are exact up to this many components.
EXACT_DIMS = 1_000
# Distances of a tile are held for so many candidates at a time.
STRIP = 8_192


def nearest(
    candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest candidates of each query by Euclidean distance.

    Candidates and queries are dealt into blocks and every query block meets every
    candidate block in one tile.  In a tile vectors are int8 codes; products of codes
    give each distance up to the two vectors' own rounding errors.  Candidates whose
    lower bound is above the k-th smallest upper bound are out; the rest are computed
    from the original components in double precision and kept in heaps of k, which are
    merged by query.

    A query's own id is no candidate.  Vectors that are null, empty, zero or hold null or
    non-finite components and rows without an id take no part; vectors of different
    lengths are not compared.  Equal rows count once; unequal rows that share an id are
    candidates each, and a query id that stands on several rows keeps the nearest of all
    of them.  Ties go to the smaller id.  Empty tables give no rows.  Other columns are
    ignored.
    """
    spark = candidates.sparkSession
    ship_code(spark)
    points = stored(_points(candidates, id_col, vector), "points")
    asked = stored(_points(queries, id_col, vector), "asked")
    least = spark.sparkContext.defaultParallelism
    blocks = task_count(points.count(), TILE_ROWS, least)
    query_blocks = task_count(asked.count(), TILE_QUERIES, 1)
    left = points.withColumns(
        {
            "block": F.pmod(F.xxhash64("id", "vector"), F.lit(blocks).cast("long")),
            "qblock": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))),
        }
    )
    right = asked.withColumns(
        {
            "block": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))),
            "qblock": F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(query_blocks)).cast("int"),
        }
    )
    keys = ["dims", "block", "qblock"]

    def tile(points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return _tile(points, asked, k)

    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(tile, "qblock int, query_id long, vec_id long, score double")
    )

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return _merge(rows, k)

    return found.groupBy("qblock", F.pmod(F.xxhash64("query_id"), F.lit(64))).applyInPandas(
        merge, "query_id long, rank int, vec_id long, score double"
    )


def _points(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    df = df.where(F.col("id").isNotNull() & valid_vectors("vector"))
    return df.dropDuplicates(["id", "vector"]).withColumn("dims", F.size("vector"))


def _coded(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, the size of each vector's step and each vector's distance from its code.

    A step of its own keeps a vector's codes fine beside one of far larger components.
    """
    step = np.maximum(np.abs(x).max(1) / 127, np.finfo(np.float64).tiny)
    codes = np.rint(x / step[:, None])
    return codes, step, np.sqrt(((x - codes * step[:, None]) ** 2).sum(1))


def _tile(points: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    if points.empty or asked.empty:
        return pd.DataFrame({"qblock": [], "query_id": [], "vec_id": [], "score": []})
    ids, qids = points["id"].to_numpy(), asked["id"].to_numpy()
    x, q = np.stack(points["vector"]), np.stack(asked["vector"])
    np.seterr(over="ignore", invalid="ignore")
    codes, step, wide = _coded(x)
    qcodes, qstep, qwide = _coded(q)
    kind = np.float32 if x.shape[1] <= EXACT_DIMS else np.float64
    small, qsmall = codes.astype(np.int8).astype(kind), qcodes.astype(np.int8).astype(kind)
    norms, qnorms = ((codes * step[:, None]) ** 2).sum(1), ((qcodes * qstep[:, None]) ** 2).sum(1)
    # Rounding of the doubles below; far under the codes' own error.
    slack, qslack = 1e-6 * np.sqrt(norms), 1e-6 * np.sqrt(qnorms)
    heaps: list[list[tuple[float, int]]] = [[] for _ in qids]
    for at in range(0, len(ids), STRIP):
        part = slice(at, at + STRIP)
        products = (qsmall @ small[part].T).astype(np.float64) * qstep[:, None] * step[part][None, :]
        near = np.sqrt(np.maximum(qnorms[:, None] + norms[part][None, :] - 2 * products, 0))
        wider = (qwide + qslack)[:, None] + (wide + slack)[part][None, :]
        own = qids[:, None] == ids[part][None, :]
        # Bounds that overflow say nothing: such pairs are computed.
        upper = np.where(own | ~np.isfinite(near + wider), np.inf, near + wider)
        bound = np.partition(upper, k - 1, axis=1)[:, k - 1] if upper.shape[1] >= k else np.full(len(qids), np.inf)
        full = np.array([-h[0][0] if len(h) == k else np.inf for h in heaps])
        rows, cols = np.nonzero(~own & ~(near - wider > np.minimum(bound, full)[:, None]))
        score = _distances(q, x[part], rows, cols)
        for r, c, s in zip(rows.tolist(), (cols + at).tolist(), score.tolist()):
            item = (-s, -int(ids[c]))
            if len(heaps[r]) < k:
                heapq.heappush(heaps[r], item)
            elif item > heaps[r][0]:
                heapq.heapreplace(heaps[r], item)
    out = [(int(qids[r]), -i, -s) for r, h in enumerate(heaps) for s, i in h]
    made = pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
    made.insert(0, "qblock", int(asked["qblock"].iloc[0]))
    return made


def _distances(q: np.ndarray, x: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Distances of chosen pairs, components added in their order."""
    score = np.empty(len(rows))
    for at in range(0, len(rows), 100_000):
        d = q[rows[at : at + 100_000]] - x[cols[at : at + 100_000]]
        total = np.zeros(len(d))
        for i in range(d.shape[1]):
            total += d[:, i] * d[:, i]
        score[at : at + 100_000] = np.sqrt(total)
    return score


def _merge(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    for query, own in rows.groupby("query_id"):
        best = heapq.nsmallest(k, set(zip(own["score"].tolist(), own["vec_id"].tolist())))
        out += [(query, r, i, s) for r, (s, i) in enumerate(best, 1)]
    return pd.DataFrame(out, columns=["query_id", "rank", "vec_id", "score"])


def op10_nearest(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


SQL = """
WITH points AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, p.vec_id AS vec_id, sqrt(list_reduce(
    list_transform(list_zip(q.v, p.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])),
    lambda x, y: x + y)) AS score
  FROM points q JOIN points p ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id AND len(p.v) = len(q.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs
) WHERE rank <= 10
"""
