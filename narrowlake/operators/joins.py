"""Joins between wide relations, and to small dimensions.

No side is marked for broadcast: Spark broadcasts one whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise splits hot keys of a
sort-merge join at run time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from narrowlake.model import COLLECTIONS, Roles
from narrowlake.session import work_dir


def cross_series_join(
    left: DataFrame,
    right: DataFrame,
    *,
    on: Sequence[str] = ("rssdid", "aod"),
    left_columns: Mapping[str, str],
    right_columns: Mapping[str, str],
    where: Column | None = None,
) -> DataFrame:
    """Filings of one series next to those of another.

    Columns are given as source name to output name.  ``where`` speaks of the
    join columns; being applied first, it reaches both sides.  A left row comes
    out once for each matching right row.
    """
    if where is not None:
        left, right = left.where(where), right.where(where)
    a = left.select(*on, *[F.col(f"`{c}`").alias(n) for c, n in left_columns.items()])
    b = right.select(*on, *[F.col(f"`{c}`").alias(n) for c, n in right_columns.items()])
    return a.join(b, list(on), "left")


def entity_view_join(
    left: DataFrame,
    right: DataFrame,
    *,
    on: str,
    left_columns: Sequence[str],
    right_columns: Mapping[str, str],
) -> DataFrame:
    """Two entity relations joined on one attribute."""
    a = left.select(F.col(on).alias("_on"), *left_columns)
    b = right.select(F.col(on).alias("_on"), *[F.col(f"`{c}`").alias(n) for c, n in right_columns.items()])
    return a.join(b, "_on", "left").drop("_on")


def items_schedule_join(
    items: DataFrame, schedule: DataFrame, on: Sequence[str] = ("filing_id",)
) -> DataFrame:
    return items.join(schedule, list(on), "inner")


def item_desc_lookup(
    narrow: DataFrame, dictionary: DataFrame, roles: Roles = COLLECTIONS
) -> DataFrame:
    """Descriptions kept once per item, joined back to the rows.

    A code that the dictionary has several times takes the largest of its
    descriptions, so no row is multiplied.
    """
    names = dictionary.groupBy(roles.item).agg(F.max(roles.desc).alias(roles.desc))
    return narrow.drop(roles.desc).join(names, roles.item, "left")


def number_codes(codes: DataFrame, order: str, name: str = "code_no") -> DataFrame:
    """Codes numbered from 0 in code order, however many there are.

    Ranges of codes are written to the shared folder; each is numbered by itself, from
    the number of codes in the ranges before it.
    """
    spark, path = codes.sparkSession, work_dir(codes.sparkSession, "codes")
    ranged = codes.repartitionByRange(order).withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(path)
    stored = spark.read.schema(ranged.schema).parquet(path)
    before = stored.groupBy("_part").count()
    before = before.select("_part", F.expr("sum(count) OVER (ORDER BY _part) - count").alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    numbered = stored.join(before, "_part").withColumn(name, F.col("_before") + own - 1)
    return numbered.drop("_part", "_before")


def assign_codes(rows: DataFrame, codes: DataFrame, *, row_id: Column, order: str) -> DataFrame:
    """Row i takes code i modulo the number of codes, as an equi-join."""
    n = codes.count()
    if not n:
        raise ValueError("a list without codes can not be assigned")
    return (
        rows.withColumn("code_no", F.pmod(row_id.cast("long"), F.lit(n).cast("long")))
        .join(number_codes(codes, order), "code_no", "inner")
        .drop("code_no")
    )


def new_files(manifest: DataFrame, ledger: DataFrame, on: Sequence[str] = ("path",)) -> DataFrame:
    """Files that no earlier load has taken."""
    return manifest.join(ledger.select(*on).distinct(), list(on), "left_anti")
