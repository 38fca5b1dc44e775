"""Loads: CSV drop to narrow table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.model import COLLECTIONS, SERIES_PREFIXES, Roles
from narrowlake.operators.filters import reject_reason
from narrowlake.operators.joins import new_files
from narrowlake.plans.compact import FILE_BYTES, compact, visible
from narrowlake.plans.lease import SECONDS, Lease
from narrowlake.sinks.tables import append_merge_schema, create_or_append, open_files, rebalanced
from narrowlake.sources.csv import FILE_INGEST, MALFORMED, SOURCE_FILE, read_by_header, stamp_ingest
from narrowlake.sources.files import valid_files

LEDGER_SCHEMA = (
    "path string, length bigint, modificationTime timestamp, sample_md5 string, ingest_ts string,"
    " header string, load_id string, state string"
)
# A file is taken again when it was written again, whatever its length and first bytes.
FILE_IDENTITY = ("path", "length", "modificationTime")
LOAD_ID = "load_id"
REASON = "reason"
# Bytes of CSV that make a stored file large enough, and those of a file whose rows one task both reads and stores.
WHOLE_BYTES, MOST_BYTES = 64 * 1024 * 1024, 256 * 1024 * 1024


class EmptyLoad(ValueError):
    """There is nothing to load."""


@dataclass(frozen=True)
class LoadReport:
    files: int
    read_rows: int
    loaded_rows: int
    rejected_rows: int
    action: str
    refused_files: int = 0


def read_drop(
    files: DataFrame,
    roles: Roles = COLLECTIONS,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    *,
    ingest_mode: str = "per_file",
    multiline: bool = True,
    extra: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Stamped rows of sniffed files, each with the reason it is refused or NULL.

    Every line of a file that is read is one row; files that are not come second, with the
    reason.
    """
    rows, refused = read_by_header(files.sparkSession, files, roles, multiline=multiline, extra=extra)
    reason = F.when(F.col(MALFORMED).isNotNull(), "malformed").otherwise(_series_reason(roles, prefixes))
    rows = stamp_ingest(rows.withColumn(REASON, reason), roles, mode=ingest_mode, files=files)
    return rows.drop(SOURCE_FILE, FILE_INGEST), refused


def _series_reason(roles: Roles, prefixes: Sequence[str]) -> Column:
    return reject_reason(roles.series, prefixes)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNull()).drop(REASON, MALFORMED)


def refused_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(REASON).isNotNull())


def stored_as_read(files: DataFrame, ingest_mode: str = "per_file") -> bool:
    """Whether the tasks that read the files may store their rows without moving them.

    A file's rows are of one ingest time.  Where an ingest time has few files for its size, or
    one, moving rows would not store them in notably fewer files.  Files that are very large keep
    one task busy with reading alone.
    """
    time = F.col("ingest_ts") if ingest_mode == "per_file" else F.lit(1)
    of_time = files.groupBy(time).agg(
        F.count(F.lit(1)).alias("n"),
        F.greatest(F.lit(1), F.ceil(F.sum("length") / WHOLE_BYTES)).alias("needed"),
        F.max("length").alias("largest"),
    )
    n, needed, largest = of_time.agg(F.sum("n"), F.sum("needed"), F.max("largest")).first()
    return n is not None and n <= 2 * needed and largest <= MOST_BYTES


def ingest(
    spark: SparkSession,
    path: str,
    table: str,
    *,
    roles: Roles = COLLECTIONS,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    ingest_mode: str = "per_file",
    reject_table: str | None = None,
    multiline: bool = True,
    extra: bool = False,
    route: str = "auto",
    fmt: str = "parquet",
    table_path: str | None = None,
) -> LoadReport:
    """Load every valid file below ``path``; a second run adds the rows again.

    Rows are counted while they are written.  The files are read a second time
    only if some rows were refused and a table is named to keep them.  ``extra``
    also loads the columns that the narrow schema does not know, added to the
    table where it lacks them.
    """
    files = valid_files(spark, path, route).persist()
    rows, refused = read_drop(
        files, roles, prefixes, ingest_mode=ingest_mode, multiline=multiline, extra=extra
    )
    n_refused = refused.count()
    n_files = files.count() - n_refused
    if n_files <= 0:
        raise EmptyLoad(f"no CSV file below {path} can be read: {[tuple(r) for r in refused.head(3)]}")
    if rows.isEmpty():
        raise EmptyLoad(f"the files below {path} hold no rows")
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("read_rows"),
        F.count_if(F.col(REASON).isNull()).alias("loaded_rows"),
    )
    taken = accepted(counted)
    moved = not stored_as_read(files, ingest_mode)
    if extra and spark.catalog.tableExists(table):
        append_merge_schema(taken, table, moved=moved)
        action = "appended"
    else:
        action = create_or_append(
            taken, table, moved=moved, partition_by=(roles.series, roles.ingest), fmt=fmt, path=table_path
        )
    read, loaded = seen.get["read_rows"], seen.get["loaded_rows"]
    if reject_table and loaded < read:
        create_or_append(refused_rows(rows), reject_table, partition_by=(), fmt=fmt)
    files.unpersist()
    return LoadReport(n_files, read, loaded, read - loaded, action, n_refused)


def narrow_schema(roles: Roles = COLLECTIONS) -> T.StructType:
    fields = [*roles.columns, roles.ingest, LOAD_ID]
    return T.StructType([T.StructField(c, T.StringType()) for c in fields])


def read_loaded(spark: SparkSession, target: str, roles: Roles = COLLECTIONS) -> DataFrame:
    """The narrow folder written by loads, without its load marks."""
    return spark.read.schema(narrow_schema(roles)).parquet(target).where(visible(spark, target)).drop(LOAD_ID)


def compact_loads(
    spark: SparkSession,
    target: str,
    ledger: str,
    *,
    roles: Roles = COLLECTIONS,
    file_bytes: int = FILE_BYTES,
    lease_seconds: float = SECONDS,
) -> list[str]:
    """Pack the finished loads of a ledger into larger files; returns the loads packed.

    It holds the lease that loads hold, so no load is written meanwhile.
    """
    with Lease(spark, lease_path(ledger), lease_seconds) as lease:
        done = read_ledger(spark, ledger).where("state = 'loaded'").select(LOAD_ID).distinct()
        finished = [r[0] for r in done.collect()]
        lease.check()
        return compact(spark, target, finished, schema=narrow_schema(roles), roles=roles, file_bytes=file_bytes)


def rejects_path(target: str) -> str:
    """Where loads into ``target`` keep refused lines and files."""
    return target.rstrip("/") + "_rejects"


def read_rejects(spark: SparkSession, target: str, roles: Roles = COLLECTIONS) -> DataFrame:
    """Refused lines and files of all loads; a refused file is a row with its path as the line."""
    fields = [*roles.columns, MALFORMED, REASON, roles.ingest, LOAD_ID]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in fields])
    try:
        return spark.read.schema(schema).parquet(rejects_path(target))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_load(
    rows: DataFrame, target: str, load_id: str, roles: Roles = COLLECTIONS, *, moved: bool = True
) -> None:
    """Write the rows of one load; writing the same load again replaces them.

    Rows that are not ``moved`` are written by the tasks that make them.
    """
    _replace_load(rows, target, load_id, (roles.series, roles.ingest, LOAD_ID), moved)


def _replace_load(
    rows: DataFrame, target: str, load_id: str, partition_by: Sequence[str], moved: bool = True
) -> None:
    marked = rows.withColumn(LOAD_ID, F.lit(load_id))
    writer = (
        (rebalanced(marked, partition_by) if moved else marked)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
    )
    with open_files(rows.sparkSession):
        writer.parquet(target)


def load_files(
    files: DataFrame,
    target: str,
    load_id: str,
    *,
    roles: Roles = COLLECTIONS,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    multiline: bool = True,
) -> tuple[int, int]:
    """Store accepted rows of sniffed files, and what was refused beside them.

    Returns the numbers of lines read and of rows stored; the rejects of the load make
    up the difference.  Running the same load again replaces what it stored.
    """
    rows, refused = read_drop(files, roles, prefixes, multiline=multiline)
    read = kept = 0
    if not rows.isEmpty():
        seen = Observation()
        counted = rows.observe(
            seen,
            F.count(F.lit(1)).alias("read"),
            F.count_if(F.col(REASON).isNull()).alias("stored"),
        )
        write_load(accepted(counted), target, load_id, roles, moved=not stored_as_read(files))
        read, kept = seen.get["read"], seen.get["stored"]
    some = not refused.isEmpty()
    if kept < read or some:
        lines = refused_rows(rows)
        if some:
            files_refused = refused.select(F.col("path").alias(MALFORMED), F.col("problem").alias(REASON))
            lines = lines.unionByName(files_refused, allowMissingColumns=True)
        _replace_load(lines, rejects_path(target), load_id, (LOAD_ID,))
    return read, kept


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def lease_path(ledger: str) -> str:
    """Where runs of a ledger take turns."""
    return ledger.rstrip("/") + "_lease"


def load_new(
    spark: SparkSession,
    path: str,
    target: str,
    ledger: str,
    *,
    roles: Roles = COLLECTIONS,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    multiline: bool = True,
    route: str = "auto",
    lease_seconds: float = SECONDS,
    gzip: bool = False,
) -> int:
    """Load the files that no earlier run has loaded; returns how many.

    Files are written down as taken before they are read and as loaded after
    their rows are stored.  A run that died in between is finished first, under
    its own load id, whose rows are replaced: no file is lost or loaded twice.
    A file that is written again under its name is a new file; its rows join
    the earlier ones, and reads of the latest state choose between them.
    Files that hold no line at all are written down as empty and raise.  ``gzip`` loads
    ``.csv.gz`` files too.

    A run holds the lease of its ledger, so a second one is refused with LeaseHeld;
    the lease of a run that died ends ``lease_seconds`` after its last sign of life.
    """
    with Lease(spark, lease_path(ledger), lease_seconds) as lease:
        count = 0
        while True:
            load_id, unfinished = _next_load(spark, path, ledger, lease, route, gzip)
            if load_id is None:
                return count
            files = read_ledger(spark, ledger).where(
                (F.col(LOAD_ID) == load_id) & (F.col("state") == "taken")
            )
            count += files.count()
            lease.check()
            read, _ = load_files(files, target, load_id, roles=roles, prefixes=prefixes, multiline=multiline)
            lease.check()
            _append_ledger(files, ledger, load_id, "loaded" if read else "empty")
            if not unfinished:
                if not read:
                    raise EmptyLoad(f"the {count} new files below {path} hold no rows")
                return count


def load_once(
    files: DataFrame,
    target: str,
    ledger: str,
    load_id: str,
    *,
    roles: Roles = COLLECTIONS,
    prefixes: Sequence[str] = SERIES_PREFIXES,
    multiline: bool = True,
    lease_seconds: float = SECONDS,
) -> bool:
    """Store sniffed files as one load and write it down in the ledger; returns whether it had to be done.

    A load that the ledger has is finished and may have been packed since, so it is not written
    again; one that died before that replaces its own rows.  Takes turns with packings by the lease.
    """
    spark = files.sparkSession
    with Lease(spark, lease_path(ledger), lease_seconds) as lease:
        if not read_ledger(spark, ledger).where(F.col(LOAD_ID) == load_id).isEmpty():
            return False
        read, _ = load_files(files, target, load_id, roles=roles, prefixes=prefixes, multiline=multiline)
        lease.check()
        _append_ledger(files, ledger, load_id, "loaded" if read else "empty")
        return True


def _next_load(
    spark: SparkSession, path: str, ledger: str, lease: Lease, route: str, gzip: bool
) -> tuple[str | None, bool]:
    """The load to be done and whether a run left it unfinished; new files are taken for it."""
    known = read_ledger(spark, ledger)
    done = known.where(F.col("state").isin("loaded", "empty")).select(LOAD_ID)
    left = known.where(F.col("state") == "taken").join(done, LOAD_ID, "left_anti").agg(F.min(LOAD_ID)).first()[0]
    if left:
        return left, True
    load_id = uuid.uuid4().hex
    taken = new_files(
        valid_files(spark, path, route, gzip), known.where(F.col("state") == "taken"), FILE_IDENTITY
    ).persist()
    try:
        if taken.isEmpty():
            return None, False
        lease.check()
        _append_ledger(taken, ledger, load_id, "taken")
    finally:
        taken.unpersist()
    return load_id, False


def _append_ledger(files: DataFrame, ledger: str, load_id: str, state: str) -> None:
    columns = ("path", "length", "modificationTime", "sample_md5", "ingest_ts", "header")
    (
        files.select(*columns, F.lit(load_id).alias(LOAD_ID), F.lit(state).alias("state"))
        .write.mode("append")
        .parquet(ledger)
    )
