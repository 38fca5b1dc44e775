"""Column operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.model import COLLECTIONS, Roles

# Columns and lengths of the documented report of items.
REPORT_LENGTHS = {
    "filing_id": 250,
    "series_id": 20,
    "schedule_id": 250,
    "rssd_id": 22,
    "as_of_date": None,
    "item_mdrm": 8,
    "item_description": 4000,
    "item_value": 4000,
    "context_level1_mdrm": 8,
    "context_level1_desc": 4000,
    "context_level1_value": 4000,
    "context_level2_mdrm": 8,
    "context_level2_desc": 4000,
    "context_level2_value": 4000,
    "context_level3_mdrm": 8,
    "context_level3_desc": 4000,
    "context_level3_value": 4000,
    "submission_datetime": "timestamp",
    "filing_status": 30,
    "estimated_flag": 250,
    "estimated_by": 250,
}


def add_literal(rows: DataFrame, name: str, value: object) -> DataFrame:
    return rows.withColumn(name, F.lit(value))


def add_created_at(rows: DataFrame, name: str = "created_at") -> DataFrame:
    return rows.withColumn(name, F.current_timestamp())


def rename_items(wide: DataFrame, keys: Sequence[str], names: Mapping[str, str]) -> DataFrame:
    """Selected items of a wide relation under business names."""
    return wide.select(*keys, *[F.col(f"`{code}`").alias(name) for code, name in names.items()])


def select_items(wide: DataFrame, keys: Sequence[str], n: int = 5, roles: Roles = COLLECTIONS) -> DataFrame:
    """The first ``n`` item columns next to ``keys``."""
    items = [c for c in wide.columns if c not in {*roles.keys, roles.ingest}]
    return wide.select(*keys, *[F.col(f"`{c}`") for c in items[:n]])


def schema_of(rows: DataFrame) -> T.StructType:
    """Analysis alone; no job runs."""
    return rows.schema


def without_desc(rows: DataFrame, roles: Roles = COLLECTIONS) -> DataFrame:
    """Everything but the descriptive columns."""
    return rows.drop(*roles.desc_columns)


def varchar(column: Column | str, length: int) -> Column:
    """CAST AS VARCHAR(n): text cut to ``length`` characters."""
    column = F.col(column) if isinstance(column, str) else column
    return F.substring(column.cast("string"), 1, length)


def report_items(items_with_schedule: DataFrame) -> DataFrame:
    """The documented report of items: typed, length-limited and distinct.

    Ids that the cut leaves alone stay as they are, so rows that a join has put together by
    filing are made distinct where they are, without another shuffle.  Only longer ids are
    cut, all of them to the full length, which the others do not reach: no report row
    comes from both.
    """
    most = REPORT_LENGTHS["filing_id"]
    whole = F.coalesce(F.length(F.col("filing_id").cast("string")) < most, F.lit(True))
    parts = []
    for rows, own in ((items_with_schedule.where(whole), True), (items_with_schedule.where(~whole), False)):
        out = []
        for name, kind in REPORT_LENGTHS.items():
            if kind is None:
                out.append(F.col(name))
            elif kind == "timestamp":
                out.append(F.col(name).try_cast("timestamp").alias(name))
            elif name == "filing_id" and own:
                out.append(F.col(name).cast("string"))
            else:
                out.append(varchar(name, kind).alias(name))
        parts.append(rows.select(*out).dropDuplicates())
    return parts[0].unionByName(parts[1])


def first_rows(rows: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """``n`` rows; the same ones every time if ``order`` is total."""
    return (rows.orderBy(*order) if order else rows).limit(n)
