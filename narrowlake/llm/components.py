"""Connected components by alternating star contractions over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrowlake.llm.common import drop, stored

# Rounds grow with the logarithm of the longest path squared; this is far above any graph.
MOST_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """(id, component): every id of the links (a, b) with the smallest id it can reach.

    Each round hangs larger neighbours and then smaller ones on the smallest known id.
    Minima are combined before the shuffle; a hub's rows are dealt out by the adaptive
    join.  Edges stay in files of the shared folder, only a count and a checksum reach
    the driver.  Loops and repeated links change nothing; null ends are dropped.
    """
    edges = (
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a != b")
        .distinct()
    )
    edges = stored(edges, "links")
    before = _state(edges)
    for _ in range(MOST_ROUNDS):
        if before[0] == 0:
            break
        last, edges = edges, stored(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        drop(last)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    edges = edges.where("a != b").distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select("a", F.col("m").alias("b"))
    return moved.union(kept).where("a != b").distinct()


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]
