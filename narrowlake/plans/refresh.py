"""Stored relations that follow the narrow table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.model import COLLECTIONS, Roles
from narrowlake.operators.pivots import discover_items, pivot_encoded
from narrowlake.session import PARALLEL_JOBS
from narrowlake.sinks.tables import merge_wide, read_stored, rebalanced, store_wide, stored_schema


def touched_series(batch: DataFrame, roles: Roles = COLLECTIONS) -> list[str]:
    """Series of a batch; as many as there are published relations."""
    return sorted(r[0] for r in batch.select(roles.series).distinct().collect() if r[0] is not None)


def refresh_summary(
    summary: DataFrame, path: str, roles: Roles = COLLECTIONS, series: Sequence[str] | None = None
) -> None:
    """Rebuild a stored summary, all of it or the part of some series.

    The summary is stored by series; only the folders of rebuilt series change.
    """
    rows = summary if series is None else summary.where(F.col(roles.series).isin(list(series)))
    writer = rebalanced(rows, [roles.series]).write.mode("overwrite")
    if series is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(roles.series).parquet(path)


def wide_path(root: str, series: str) -> str:
    """Folder of a series; any two series have different ones, also where case does not count."""
    name = quote(series, safe="").replace(".", "%2E")
    mark = "" if series == series.upper() else f"-{zlib.crc32(series.encode()):08x}"
    return f"{root.rstrip('/')}/{name}{mark}_wide"


def refresh_series(
    narrow: DataFrame, root: str, series: Sequence[str], roles: Roles = COLLECTIONS
) -> None:
    """Rebuild the stored wide relation of each given series from all its rows.

    Each is switched when it is written in full; readers see the earlier one until then.
    """
    chosen = narrow.where(F.col(roles.series).isin(list(series)))
    found = discover_items(chosen, roles)

    def rebuild(name: str) -> None:
        wide = pivot_encoded(narrow, name, roles=roles, items=found[name])
        store_wide(wide, wide_path(root, name), partition_by=[roles.as_of] if roles.as_of else ())

    _for_each(rebuild, found)


def changed_filings(
    narrow: DataFrame, batch: DataFrame, series: str, roles: Roles = COLLECTIONS
) -> DataFrame:
    """Wide rows of the filings of one series that a batch has rows of.

    The rows come from the whole narrow table, so what earlier batches brought
    to the same filings is kept.
    """
    of_series = F.col(roles.series) == series
    keys = list(roles.keys)
    touched = batch.where(of_series).select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    rows = narrow.where(of_series)
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return pivot_encoded(rows.join(touched, same, "left_semi"), roles=roles)


def refresh_filings(batch: DataFrame, root: str, roles: Roles = COLLECTIONS) -> None:
    """Merge a batch into the stored wide relations of its series.

    Reads the batch and the dates it has filings of, however long the series' history.
    A series without a stored relation gets one.  Folders that are not touched keep the
    columns they were written with, so read with ``read_wide``.
    """

    def refresh(series: str) -> None:
        wide = pivot_encoded(batch, series, roles=roles).persist()
        try:
            merge_wide(wide, wide_path(root, series), keys=roles.keys, partition_by=[roles.as_of])
        finally:
            wide.unpersist()

    _for_each(refresh, touched_series(batch, roles))


def _for_each(job: Callable[[str], None], names: Iterable[str]) -> None:
    """Run the jobs of several series side by side; the first failure is raised."""
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        list(pool.map(job, names))


def read_wide(
    spark: SparkSession, root: str, series: str, roles: Roles = COLLECTIONS
) -> DataFrame:
    """A stored wide relation with the columns of all its folders, keys as text."""
    path = wide_path(root, series)
    keys = set(roles.keys)
    schema = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in keys else f.dataType)
            for f in stored_schema(spark, path) or ()
        ]
    )
    return read_stored(spark, path, schema)
