"""Loads as streams over the drop folder.

The stream is one of files; each batch of files goes through the same load as
a batch run: sniffed, read by header, refused lines kept.  ``availableNow`` reads
what has arrived since the last run and stops, so the same query serves an
arrival trigger, a daily schedule and a backlog.  A target belongs to the query that
first wrote to it; another query, or the same one with a lost checkpoint, is refused.
With a ledger, finished batches stand in it, so that they can be packed between runs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from narrowlake.model import COLLECTIONS, SERIES_PREFIXES, Roles
from narrowlake.plans.compact import visible
from narrowlake.plans.ingest import LOAD_ID, load_files, load_once, narrow_schema, read_loaded
from narrowlake.plans.refresh import refresh_filings, refresh_series, touched_series
from narrowlake.sources.files import CSV_GLOB, sniffed, with_heads

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


class TargetTaken(ValueError):
    """The target was written by another query."""


def read_drop_stream(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files as they arrive; their contents are not read here."""
    reader = (
        spark.readStream.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=CSV_GLOB)
        .schema(FILE_SCHEMA)
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).where("length > 0").select("path", "length", "modificationTime")


def _owner(spark: SparkSession, target: str) -> str | None:
    try:
        return spark.read.text(target.rstrip("/") + "_owner").first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _claim(spark: SparkSession, target: str, query: str) -> None:
    """Write the query down as the one that loads the target, or refuse it."""
    owner = _owner(spark, target)
    if owner is None:
        spark.createDataFrame([(query,)], "value string").coalesce(1).write.text(target.rstrip("/") + "_owner")
        owner = _owner(spark, target)
    if owner != query:
        raise TargetTaken(f"{target} is loaded by query {owner}, not by {query}")


def _start(
    files: DataFrame,
    target: str,
    checkpoint: str,
    roles: Roles,
    prefixes: Sequence[str],
    multiline: bool,
    then: Callable[[SparkSession, str], None],
    ledger: str | None = None,
) -> StreamingQuery:
    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The id that the checkpoint keeps, so a batch that is run again has the same load id.
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        _claim(spark, target, query)
        valid = sniffed(with_heads(batch)).where("is_csv").drop("is_csv").persist()
        try:
            if valid.isEmpty():
                return
            load_id = f"{query}-{batch_id:012d}"
            how = {"roles": roles, "prefixes": prefixes, "multiline": multiline}
            if ledger is None:
                load_files(valid, target, load_id, **how)
            else:
                load_once(valid, target, ledger, load_id, **how)
        finally:
            valid.unpersist()
        then(spark, load_id)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_stream(
    files: DataFrame,
    target: str,
    checkpoint: str,
    roles: Roles = COLLECTIONS,
    *,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    multiline: bool = True,
    ledger: str | None = None,
) -> StreamingQuery:
    """Store the accepted rows of new files once each; a batch run again replaces its own rows.

    A ledger takes down the batches whose rows are stored.  ``compact_loads`` packs these,
    between batches or between runs: both hold the lease of the ledger.
    """
    return _start(files, target, checkpoint, roles, prefixes, multiline, lambda spark, load_id: None, ledger)


def read_stream_table(spark: SparkSession, target: str, roles: Roles = COLLECTIONS) -> DataFrame:
    return read_loaded(spark, target, roles)


def refresh_stream(
    files: DataFrame,
    target: str,
    wide_root: str,
    checkpoint: str,
    *,
    roles: Roles = COLLECTIONS,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    multiline: bool = True,
    refresh: str = "filings",
) -> StreamingQuery:
    """Store each batch, then bring the wide relations of its series up to date.

    ``filings`` merges the batch into the dates it has filings of, and reads nothing but
    the batch and those dates; ``series`` rebuilds each of its series from all rows.
    A rerun of a batch changes nothing.
    """
    if refresh not in {"filings", "series"}:
        raise ValueError(f"unknown refresh {refresh!r}")

    def then(spark: SparkSession, load_id: str) -> None:
        loaded = spark.read.schema(narrow_schema(roles)).parquet(target).where(visible(spark, target))
        mine = loaded.where(F.col(LOAD_ID) == load_id).drop(LOAD_ID)
        if refresh == "filings":
            refresh_filings(mine, wide_root, roles)
        elif series := touched_series(mine, roles):
            refresh_series(loaded.drop(LOAD_ID), wide_root, series, roles)

    return _start(files, target, checkpoint, roles, prefixes, multiline, then)
