"""Row filters of narrow and wide relations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from narrowlake.functions.dates import as_date
from narrowlake.model import COLLECTIONS, KV, SERIES_PREFIXES, UNKNOWN_INGEST, Roles


def series_is_valid(series: Column | str, prefixes: Sequence[str] = SERIES_PREFIXES) -> Column:
    """A series is valid by its prefix alone; NULL is not valid."""
    series = F.col(series) if isinstance(series, str) else series
    hit = reduce(lambda a, b: a | b, [series.startswith(p) for p in prefixes])
    return F.coalesce(hit, F.lit(False))


def valid_series(
    rows: DataFrame, roles: Roles = COLLECTIONS, prefixes: Sequence[str] = SERIES_PREFIXES
) -> DataFrame:
    """Rows of accepted series; all rows if the relation has no series column."""
    if roles.series not in rows.columns:
        return rows
    return rows.where(series_is_valid(roles.series, prefixes))


def reject_reason(series: Column | str, prefixes: Sequence[str] = SERIES_PREFIXES) -> Column:
    """Why a row is refused; NULL for an accepted row."""
    series = F.col(series) if isinstance(series, str) else series
    return (
        F.when(series.isNull(), "null series")
        .when(series == "", "blank series")
        .when(~series_is_valid(series, prefixes), "unknown series")
    )


def rejected_rows(
    rows: DataFrame, roles: Roles = COLLECTIONS, prefixes: Sequence[str] = SERIES_PREFIXES
) -> DataFrame:
    """The complement of ``valid_series``, each row with its reason."""
    if roles.series not in rows.columns:
        return rows.where(F.lit(False)).withColumn("reason", F.lit(None).cast("string"))
    return rows.withColumn("reason", reject_reason(roles.series, prefixes)).where(
        F.col("reason").isNotNull()
    )


def valid_discriminators(
    narrow: DataFrame, roles: Roles = COLLECTIONS, prefixes: Sequence[str] = SERIES_PREFIXES
) -> DataFrame:
    """Distinct series that the wide publisher takes."""
    return valid_series(narrow.select(roles.series).distinct(), roles, prefixes)


def by_series(narrow: DataFrame, series: str, roles: Roles = COLLECTIONS) -> DataFrame:
    return narrow.where(F.col(roles.series) == series)


def by_partition(
    narrow: DataFrame, series: str, ingest: str, roles: Roles = COLLECTIONS
) -> DataFrame:
    return narrow.where((F.col(roles.series) == series) & (F.col(roles.ingest) == ingest))


def by_ingest(narrow: DataFrame, ingest: str, roles: Roles = COLLECTIONS) -> DataFrame:
    return narrow.where(F.col(roles.ingest) == ingest)


def by_key(narrow: DataFrame, code: str, roles: Roles = KV) -> DataFrame:
    """One item across all series."""
    return narrow.where(F.col(roles.item) == code).select(*roles.filing_keys, roles.value)


def by_as_of(rows: DataFrame, as_of: str, roles: Roles = COLLECTIONS) -> DataFrame:
    return rows.where(F.col(roles.as_of) == as_of)


def by_columns(rows: DataFrame, **equal: object) -> DataFrame:
    """Equality on any columns, such as the entity columns."""
    return reduce(lambda df, kv: df.where(F.col(kv[0]) == F.lit(kv[1])), equal.items(), rows)


def not_null(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))


def recent_days(
    rows: DataFrame, column: str, days: int = 30, today: date | Column | None = None
) -> DataFrame:
    """Rows dated within ``days`` of a day, by default of the current date."""
    day = F.current_date() if today is None else today
    day = F.lit(day) if isinstance(day, date) else day
    return rows.where(F.col(column) >= F.date_sub(day, days))


def recent_as_of(
    rows: DataFrame, days: int, today: date | Column | None = None, roles: Roles = COLLECTIONS
) -> DataFrame:
    dated = rows.withColumn("report_date", as_date(roles.as_of))
    return recent_days(dated, "report_date", days, today)


def unknown_ingest(narrow: DataFrame, roles: Roles = COLLECTIONS) -> DataFrame:
    """Rows whose file path named no ingest time."""
    return narrow.where(F.col(roles.ingest) == UNKNOWN_INGEST)
