"""Data-quality checks as relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.model import COLLECTIONS, Roles
from narrowlake.operators.filters import unknown_ingest


def non_empty(rows: DataFrame, what: str = "relation") -> DataFrame:
    """The relation itself; an error if it has no rows."""
    if rows.isEmpty():
        raise ValueError(f"{what} is empty")
    return rows


def all_string_columns(rows: DataFrame) -> list[str]:
    """Columns that are not strings; none if the relation passes."""
    return [f.name for f in rows.schema.fields if not isinstance(f.dataType, T.StringType)]


def unknown_ingest_count(narrow: DataFrame, roles: Roles = COLLECTIONS) -> DataFrame:
    return unknown_ingest(narrow, roles).agg(F.count(F.lit(1)).alias("unknown_rows"))


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has."""
    return (
        rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def duplicate_items(narrow: DataFrame, roles: Roles = COLLECTIONS) -> DataFrame:
    """Logical keys whose rows the pivots collapse to the largest cell."""
    return repeated_keys(narrow, roles.logical_key)


def filing_row_check(wide: DataFrame, narrow: DataFrame, roles: Roles = COLLECTIONS) -> DataFrame:
    """Filings that a wide relation holds not exactly once, or not at all.

    Both sides meet in one aggregation and are combined on the map side first.
    """
    keys = list(roles.keys)
    have = wide.select(*keys, F.lit(1).alias("wide_rows"), F.lit(0).alias("_filed"))
    filed = narrow.select(*keys, F.lit(0).alias("wide_rows"), F.lit(1).alias("_filed"))
    return (
        have.unionByName(filed)
        .groupBy(*keys)
        .agg(F.sum("wide_rows").alias("wide_rows"), F.max("_filed").alias("_filed"))
        .where("wide_rows != 1 OR _filed = 0")
        .select(*keys, "wide_rows")
    )
