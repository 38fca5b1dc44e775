"""Counts, distincts and summaries; all combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from narrowlake.functions.dates import as_date
from narrowlake.model import COLLECTIONS, KV, SERIES_PREFIXES, Roles
from narrowlake.operators.filters import series_is_valid


def total_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def rows_by(rows: DataFrame, *columns: str) -> DataFrame:
    """COUNT(*) by any columns: series, partition, entity pair, series and date."""
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("record_count"))


def distinct_values(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns).distinct()


def distinct_items(narrow: DataFrame, series: str, roles: Roles = COLLECTIONS) -> DataFrame:
    return distinct_values(narrow.where(F.col(roles.series) == series), roles.item)


def distinct_rows(rows: DataFrame) -> DataFrame:
    return rows.dropDuplicates()


def validity_counts(
    rows: DataFrame, roles: Roles = COLLECTIONS, prefixes: Sequence[str] = SERIES_PREFIXES
) -> DataFrame:
    """Total, accepted and refused rows in one pass."""
    valid = series_is_valid(roles.series, prefixes)
    return rows.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(~valid).alias("invalid_rows"),
    )


def filing_summary(
    narrow: DataFrame, series: str | None = None, roles: Roles = COLLECTIONS
) -> DataFrame:
    """Rows and latest submission of every filing."""
    rows = narrow if series is None else narrow.where(F.col(roles.series) == series)
    return rows.groupBy(*roles.filing_keys).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max(roles.submission).alias("latest_submission"),
    )


def daily_summary(narrow: DataFrame, roles: Roles = KV, item_like: str = "RCON%") -> DataFrame:
    """Institutions, rows, rows of one kind of item, and latest submission by day."""
    return narrow.groupBy(F.col(roles.series), as_date(roles.as_of).alias("report_date")).agg(
        F.count_distinct(F.col(roles.entity)).alias("institution_count"),
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.when(F.col(roles.item).like(item_like), 1).otherwise(0)).alias("rcon_fields"),
        F.max(roles.submission).alias("latest_submission"),
    )
