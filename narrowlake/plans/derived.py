"""Relations kept up with the narrow table, load by load.

Each is stored by partitions that are switched (``sinks.versions``).  A load reads itself
and the partitions it touches, whatever the history; loading it again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.functions.dates import as_date
from narrowlake.functions.files import before_ingest
from narrowlake.model import COLLECTIONS, KV, Roles
from narrowlake.operators.latest import latest_submission
from narrowlake.operators.pivots import pivot_encoded
from narrowlake.plans.refresh import wide_path
from narrowlake.sinks import versions
from narrowlake.sinks.tables import _touched, drop_old_ingests, read_stored

LOAD = "load_id"


def _stored_part(spark: SparkSession, path: str, where: Column) -> tuple[versions.Version | None, DataFrame | None]:
    base = versions.current(spark, path)
    return base, None if base is None else versions.read(spark, path, base).where(where)


# ---------------------------------------------------------------- current state


def merge_latest(batch: DataFrame, path: str, roles: Roles = COLLECTIONS, tie_break: Sequence[str] = ()) -> None:
    """Bring a stored current state up to date with a batch of narrow rows.

    The state is the latest row of every (filing, item), by as-of date.  The latest of the
    stored and the new rows is that of all rows, so only the batch and its dates are read.
    """
    where = _touched(batch, [roles.as_of])
    if where is None:
        return
    base, kept = _stored_part(batch.sparkSession, path, where)
    rows = batch if kept is None else kept.unionByName(batch, allowMissingColumns=True)
    versions.switch(latest_submission(rows, roles, tie_break), path, [roles.as_of], base=base)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path)


# ---------------------------------------------------------------- daily summary


def merge_summary(
    batch: DataFrame, path: str, load_id: str, roles: Roles = KV, item_like: str = "RCON%"
) -> None:
    """Add a load to the stored state of the daily summary.

    The state holds, for each day, the rows, rows of one kind of item and latest submission
    of every institution and load: numbers that add up, and institutions that can be counted
    exactly whatever later loads bring.  A load that is added again takes the place of what
    it added before.
    """
    own = batch.groupBy(roles.series, roles.as_of, roles.entity).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum(F.when(F.col(roles.item).like(item_like), 1).otherwise(0)).alias("rcon_fields"),
        F.max(roles.submission).alias("latest_submission"),
    )
    own = own.withColumn(LOAD, F.lit(load_id))
    where = _touched(batch, [roles.as_of])
    if where is None:
        return
    base, kept = _stored_part(batch.sparkSession, path, where)
    rows = own if kept is None else kept.where(F.col(LOAD) != load_id).unionByName(own)
    versions.switch(rows, path, [roles.as_of], base=base)


def fold_loads(spark: SparkSession, path: str, loads: Sequence[str], roles: Roles = KV) -> None:
    """Add up finished loads in the state, so that it holds one row of each institution and day again.

    They can not be added again after that: their place is taken by no id.
    """
    base = versions.current(spark, path)
    if base is None:
        return
    keys = [roles.series, roles.as_of, roles.entity]
    load = F.when(F.col(LOAD).isin(list(loads)), F.lit("")).otherwise(F.col(LOAD)).alias(LOAD)
    rows = versions.read(spark, path, base).groupBy(*keys, load).agg(
        F.sum("total_records").alias("total_records"),
        F.sum("rcon_fields").alias("rcon_fields"),
        F.max("latest_submission").alias("latest_submission"),
    )
    versions.switch(rows, path, [roles.as_of], base=base, whole=True)


def kept_summary(spark: SparkSession, path: str, roles: Roles = KV) -> DataFrame:
    """The daily summary, from its stored state."""
    state = read_stored(spark, path)
    return state.groupBy(F.col(roles.series), as_date(roles.as_of).alias("report_date")).agg(
        F.count_distinct(F.col(roles.entity)).alias("institution_count"),
        F.sum("total_records").alias("total_records"),
        F.sum("rcon_fields").alias("rcon_fields"),
        F.max("latest_submission").alias("latest_submission"),
    )


# ---------------------------------------------------------------- item codes


def merge_codes(batch: DataFrame, path: str, roles: Roles = COLLECTIONS) -> None:
    """Add the series and item codes of a batch to the stored ones, which publishing reads instead of the table."""
    own = batch.select(roles.series, F.col(roles.item).cast("string").alias(roles.item)).distinct()
    where = _touched(own, [roles.series])
    if where is None:
        return
    base, kept = _stored_part(batch.sparkSession, path, where)
    if kept is not None:
        if own.join(kept, [own[c].eqNullSafe(kept[c]) for c in own.columns], "left_anti").isEmpty():
            return  # most loads bring no new code
        own = own.unionByName(kept).distinct()
    versions.switch(own, path, [roles.series], base=base)


def read_codes(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path)


# ---------------------------------------------------------------- retention


def retain(
    spark: SparkSession, table: str, older_than: str, wide_root: str, roles: Roles = COLLECTIONS
) -> list[str]:
    """Drop old ingests of a table, from the stored wide relations too; returns the partitions dropped.

    A maximum can not be undone, so the dates that lose rows are pivoted again from the
    rows that stay, and dates without any lose their folder; other dates are neither read
    nor written.  The relations are switched before the partitions are dropped: a run
    that dies in between finds the same rows to drop again.
    """
    rows = spark.table(table)
    old = before_ingest(F.col(roles.ingest), older_than)
    lost: dict[str, list[str | None]] = {}
    # Series and dates, as many as there are folders to write again.
    for series, date in rows.where(old).select(roles.series, roles.as_of).distinct().collect():
        if series is not None:
            lost.setdefault(series, []).append(date)
    for series, dates in sorted(lost.items()):
        path = wide_path(wide_root, series)
        base = versions.current(spark, path)
        if base is None:
            continue
        on_dates = F.col(roles.as_of).isin([d for d in dates if d is not None])
        if None in dates:
            on_dates = on_dates | F.col(roles.as_of).isNull()
        kept = rows.where(~F.coalesce(old, F.lit(False)) & on_dates & (F.col(roles.series) == series))
        names = {d if d is not None else "__HIVE_DEFAULT_PARTITION__" for d in dates}
        emptied = [p for p in base.folders if unquote(p.split("=", 1)[1]) in names]
        versions.switch(pivot_encoded(kept, series, roles=roles), path, [roles.as_of], base=base, emptied=emptied)
    return drop_old_ingests(spark, table, older_than, roles)
