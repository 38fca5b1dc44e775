"""Set operators and comparison of relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrowlake.model import COLLECTIONS, SERIES_PREFIXES, Roles
from narrowlake.operators.filters import series_is_valid


def series_difference(
    narrow: DataFrame, roles: Roles = COLLECTIONS, prefixes: Sequence[str] = SERIES_PREFIXES
) -> DataFrame:
    """Series that are present but not published.

    The published ones are a row-wise condition, so their difference from all
    series is one distinct instead of a join of the table with itself.
    """
    return narrow.select(roles.series).distinct().where(~series_is_valid(roles.series, prefixes))


def compare_outputs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that two relations hold a different number of times; empty if equal.

    Two EXCEPT ALL in one shuffle: rows are counted on the map side with their
    side as a sign.
    """
    columns = left.columns
    both = left.withColumn("_left", F.lit(1)).unionByName(right.withColumn("_left", F.lit(0)))
    return (
        both.groupBy(*columns)
        .agg(
            F.sum("_left").alias("left_rows"),
            F.sum(1 - F.col("_left")).alias("right_rows"),
        )
        .where(F.col("left_rows") != F.col("right_rows"))
    )


def _checksums(rows: DataFrame, keys: Sequence[str], buckets: int, side: str) -> DataFrame:
    """Rows and two order-free checksums of each bucket of keys."""
    columns = sorted(rows.columns)
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(38,0)")).alias(f"{side}_{seed}") for seed in (1, 2)
    ]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets).cast("bigint")).alias("_bucket")
    return rows.groupBy(bucket).agg(F.count(F.lit(1)).alias(f"{side}_rows"), *sums)


def unequal_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """Buckets of keys in which two relations differ; what is shuffled is a row per bucket and task."""
    both = _checksums(left, keys, buckets, "a").join(_checksums(right, keys, buckets, "b"), "_bucket", "full")
    same = [F.col(f"a_{x}").eqNullSafe(F.col(f"b_{x}")) for x in ("rows", "1", "2")]
    return both.where(~(same[0] & same[1] & same[2])).select("_bucket")


def compare_by_checksum(
    left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int = 4096
) -> DataFrame:
    """``compare_outputs`` for relations that are mostly equal.

    Rows are summed up by buckets of their keys first; only rows of buckets that differ are
    compared.  Equal rows share their keys, so no difference is lost unless both 64-bit sums
    of a bucket agree by chance.  There are ``buckets`` of them at most, so they are sent to all tasks.
    """
    differing = F.broadcast(unequal_buckets(left, right, keys, buckets))
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets).cast("bigint"))
    parts = [
        rows.withColumn("_bucket", bucket).join(differing, "_bucket", "left_semi").drop("_bucket")
        for rows in (left, right.select(*left.columns))
    ]
    return compare_outputs(*parts)
