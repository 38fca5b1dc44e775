"""Writes to partitioned tables and folders.

Every partitioned write goes through a rebalance on the partition columns: small
partitions are written by one task each, and a partition that holds a large
share of the rows is split over many tasks.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from itertools import batched
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.functions.cells import quoted, text_literal
from narrowlake.functions.files import before_ingest
from narrowlake.model import COLLECTIONS, Roles
from narrowlake.sinks import versions


# Partitions that one catalog statement drops.
PARTITIONS_PER_DROP = 200

# Files that a task holds open at once; rows of more partitions than these are sorted by it.
OPEN_FILES = 64
_WRITING = threading.Lock()
_WRITERS: Counter[str] = Counter()
_BEFORE: dict[str, str] = {}


@contextmanager
def open_files(spark: SparkSession) -> Iterator[None]:
    """Writes inside put the rows of a few partitions into their files as they come, not sorted first.

    The sort, and what it spills, is needed only where a task meets more partitions than
    OPEN_FILES.  Meant for narrow rows: an open file of thousands of columns takes much
    memory.  Threads of one session may be inside together.
    """
    key, session = "spark.sql.maxConcurrentOutputFileWriters", spark._jsparkSession.sessionUUID()
    with _WRITING:
        if not _WRITERS[session]:
            _BEFORE[session] = spark.conf.get(key)
            spark.conf.set(key, str(OPEN_FILES))
        _WRITERS[session] += 1
    try:
        yield
    finally:
        with _WRITING:
            _WRITERS[session] -= 1
            if not _WRITERS[session]:
                spark.conf.set(key, _BEFORE.pop(session))


def table_name(name: str) -> str:
    """A dotted name as SQL text."""
    return ".".join(quoted(part) for part in name.split("."))


def partitions_of(roles: Roles = COLLECTIONS) -> tuple[str, str]:
    return (roles.series, roles.ingest)


def rebalanced(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.hint("rebalance", *columns) if columns else rows


def create_partitioned(
    rows: DataFrame,
    table: str,
    *,
    partition_by: Sequence[str] = partitions_of(),
    fmt: str = "parquet",
    path: str | None = None,
    properties: Mapping[str, str] | None = None,
    moved: bool = True,
) -> None:
    """A new table with the rows, partitioned.

    Rows that are not ``moved`` are written by the tasks that make them, for rows that come by
    partition already.
    """
    writer = (rebalanced(rows, partition_by) if moved else rows).write.format(fmt).partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    with open_files(rows.sparkSession):
        writer.saveAsTable(table)
    if properties:
        set_table_properties(rows.sparkSession, table, properties)


def append_batch(rows: DataFrame, table: str, *, moved: bool = True) -> None:
    """Add rows to a table, columns matched by name; ``moved`` as in ``create_partitioned``.

    File tables keep their partition columns last, so matching by position would
    put values into the wrong columns.
    """
    spark = rows.sparkSession
    target = spark.table(table)
    missing = set(rows.columns) - set(target.columns)
    if missing:
        raise ValueError(f"{table} has no column {sorted(missing)}; add it first")
    partition_by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    view = f"narrowlake_batch_{uuid4().hex}"
    (rebalanced(rows, partition_by) if moved else rows).createOrReplaceTempView(view)
    try:
        with open_files(spark):
            spark.sql(f"INSERT INTO {table_name(table)} BY NAME SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def create_or_append(rows: DataFrame, table: str, *, moved: bool = True, **create: object) -> str:
    """Create the table on its first load, add to it on later ones."""
    if rows.sparkSession.catalog.tableExists(table):
        append_batch(rows, table, moved=moved)
        return "appended"
    create_partitioned(rows, table, moved=moved, **create)
    return "created"


def replace_wide_table(
    wide: DataFrame, table: str, *, partition_by: Sequence[str] = (), path: str | None = None
) -> None:
    """A wide relation stored as a snappy table in place of any earlier one.

    The rows are written in full under another name first, so the table is missing for two
    catalog calls, not for the time of the write, and an error while writing leaves it
    alone.  Under a path, every write has a folder of its own below it.
    """
    spark, mark = wide.sparkSession, uuid4().hex
    if not spark.catalog.tableExists(table):
        _save_wide(wide, table, partition_by, path and f"{path.rstrip('/')}/{mark}")
        return
    place = path or spark.sql(f"DESCRIBE DATABASE {table_name(_database_of(spark, table))}").where(
        "info_name = 'Location'"
    ).first()["info_value"]
    folder = f"{place.rstrip('/')}/{table.rsplit('.', 1)[-1]}-{mark}" if not path else f"{place.rstrip('/')}/{mark}"
    staged = f"{table}_{mark[:8]}"
    _save_wide(wide, staged, partition_by, folder)
    spark.sql(f"DROP TABLE {table_name(table)}")
    rename_table(spark, staged, table)


def _database_of(spark: SparkSession, table: str) -> str:
    return table.rpartition(".")[0] or spark.catalog.currentDatabase()


def _save_wide(wide: DataFrame, table: str, partition_by: Sequence[str], path: str | None) -> None:
    writer = rebalanced(wide, partition_by).write.format("parquet").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_parquet(
    rows: DataFrame, path: str, *, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    writer = rebalanced(rows, partition_by).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv_drop(rows: DataFrame, path: str, roles: Roles = COLLECTIONS) -> None:
    """CSV with a header under ``ingest_ts=<time>/``, text kept as it is."""
    dropped = rows.select(*roles.columns, F.col(roles.ingest).alias("ingest_ts"))
    writer = (
        rebalanced(dropped, ["ingest_ts"])
        .write.mode("append")
        .partitionBy("ingest_ts")
        .options(header=True, quote='"', escape='"')
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    )
    with open_files(rows.sparkSession):
        writer.csv(path)


def set_table_properties(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {table_name(table)} SET TBLPROPERTIES ({pairs})")


def add_columns(spark: SparkSession, table: str, columns: Mapping[str, str]) -> None:
    """New columns; rows that are already there read NULL.  No data is rewritten."""
    parts = ", ".join(f"{quoted(name)} {kind}" for name, kind in columns.items())
    spark.sql(f"ALTER TABLE {table_name(table)} ADD COLUMNS ({parts})")


def append_merge_schema(rows: DataFrame, table: str, *, moved: bool = True) -> list[str]:
    """Append rows that may bring new columns; returns the columns added."""
    spark = rows.sparkSession
    present = {c.lower() for c in spark.table(table).columns}
    new = {
        f.name: f.dataType.simpleString()
        for f in rows.schema.fields
        if f.name.lower() not in present
    }
    if new:
        add_columns(spark, table, new)
    append_batch(rows, table, moved=moved)
    return list(new)


def rename_columns(
    spark: SparkSession,
    table: str,
    new_table: str,
    names: Mapping[str, str],
    *,
    path: str | None = None,
) -> None:
    """Rename columns by a rewrite into a new table, as file tables need it.

    Partition columns keep their role under their new name.
    """
    rows = spark.table(table)
    partition_by = [
        names.get(c.name, c.name) for c in spark.catalog.listColumns(table) if c.isPartition
    ]
    create_partitioned(
        rows.withColumnsRenamed(dict(names)), new_table, partition_by=partition_by, path=path
    )


def ctas_verify_counts(
    spark: SparkSession, table: str, new_table: str, *, path: str | None = None
) -> int:
    """Copy a table under a new name and compare the row counts."""
    partition_by = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    rows = spark.table(table)
    create_partitioned(rows, new_table, partition_by=partition_by, path=path)
    before, after = rows.count(), spark.table(new_table).count()
    if before != after:
        raise ValueError(f"{table} has {before} rows, its copy {new_table} has {after}")
    return after


def rename_table(spark: SparkSession, table: str, new_table: str) -> None:
    """Rename a table.

    Spark's session catalog moves the files of a managed table on a rename but
    not the locations of its partitions, which would then read as empty.
    """
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory":
        managed = spark.catalog.getTable(table).tableType == "MANAGED"
        if managed and any(c.isPartition for c in spark.catalog.listColumns(table)):
            raise ValueError(f"{table} is managed and partitioned; store it under a path to rename it")
    spark.sql(f"ALTER TABLE {table_name(table)} RENAME TO {table_name(new_table)}")


def upsert_rows(current: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows with the changed ones in place of those of the same key.

    Columns that only one side has read NULL on the other.  Keys compare NULL-safe.
    """
    marked = changed.select(*[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)]).distinct()
    same = None
    for n, k in enumerate(keys):
        part = F.col(k).eqNullSafe(F.col(f"_{n}"))
        same = part if same is None else same & part
    kept = current.join(marked, same, "left_anti")
    return kept.unionByName(changed, allowMissingColumns=True)


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema of a stored relation; None if there is none.  Its record tells, no data file is opened."""
    version = versions.current(spark, path)
    return version and version.schema


def read_stored(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored relation as its last complete write left it."""
    version = versions.current(spark, path, schema)
    if version is None:
        raise FileNotFoundError(f"no relation is stored at {path}")
    return versions.read(spark, path, version, schema)


def store_wide(wide: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """Store a relation in place of any earlier one, which stays readable until the new one is whole."""
    base = versions.current(wide.sparkSession, path, wide.schema)
    versions.switch(wide, path, partition_by, base=base, whole=True)


def _touched(changed: DataFrame, partition_by: Sequence[str]) -> Column | None:
    """A filter on the partitions of the changed rows; None without rows.

    Their names, not their rows, pass through the driver, as in any write of partitions.
    """
    values = changed.select(*partition_by).distinct().collect()
    if not values:
        return None
    if len(partition_by) > 1:
        return reduce(
            lambda a, b: a | b,
            [
                reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in row.asDict().items()])
                for row in values
            ],
        )
    (name,) = partition_by
    known = [row[0] for row in values if row[0] is not None]
    hit = F.col(name).isin(known) if known else F.lit(False)
    return hit | F.col(name).isNull() if len(known) < len(values) else hit


def _check_partitions(keys: Sequence[str], partition_by: Sequence[str]) -> None:
    others = sorted(set(partition_by) - set(keys))
    if others:
        raise ValueError(f"partition columns {others} are no keys: a changed row could leave its old one behind")


def merge_wide(
    batch: DataFrame, path: str, *, keys: Sequence[str], partition_by: Sequence[str]
) -> None:
    """Merge the wide rows of a batch into a stored wide relation, cell by cell.

    A cell is the largest value of its rows, so the larger of the stored and the new
    cell is that of all rows: nothing but the batch and the touched partitions is
    read, and merging a batch again changes nothing.  The touched partitions are
    written aside and switched, so a merge that dies leaves the relation as it was, or
    as it should be.
    """
    _check_partitions(keys, partition_by)
    spark = batch.sparkSession
    where = _touched(batch, partition_by)
    if where is None:
        return
    base = versions.current(spark, path)
    rows = batch
    if base is not None:
        rows = versions.read(spark, path, base).where(where).unionByName(batch, allowMissingColumns=True)
        cells = [c for c in rows.columns if c not in set(keys)]
        rows = rows.groupBy(F.xxhash64(*keys).alias("_sort"), *keys).agg(
            *[F.expr(f"max({quoted(c)}) AS {quoted(c)}") for c in cells]
        ).drop("_sort")
    versions.switch(rows, path, partition_by, base=base)


def upsert_wide(
    changed: DataFrame, path: str, *, keys: Sequence[str], partition_by: Sequence[str]
) -> None:
    """Put changed filings in place of those of the same key in a stored wide relation.

    Only partitions with changed filings are read and written again; their names,
    not their rows, are what passes through the driver.  They are switched as in
    ``merge_wide``.
    """
    _check_partitions(keys, partition_by)
    spark = changed.sparkSession
    # Partition values are read back in the type of the changed rows, not guessed.
    kinds = {f.name: f.dataType for f in changed.schema.fields}
    changed = changed.persist()
    try:
        where = _touched(changed, partition_by)
        if where is None:
            return
        base = versions.current(spark, path)
        rows = changed
        if base is not None:
            schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in base.schema.fields])
            rows = upsert_rows(versions.read(spark, path, base, schema).where(where), changed, keys)
        versions.switch(rows, path, partition_by, base=base)
    finally:
        changed.unpersist()


def drop_old_ingests(
    spark: SparkSession, table: str, older_than: str, roles: Roles = COLLECTIONS
) -> list[str]:
    """Drop whole ingest partitions before a bound; returns their names.

    Only catalog entries and folders are touched, no row is read.
    """
    specs = spark.sql(f"SHOW PARTITIONS {table_name(table)}")
    ingest = F.url_decode(F.regexp_extract("partition", f"(?:^|/){roles.ingest}=([^/]*)", 1))
    dropped = [r[0] for r in specs.where(before_ingest(ingest, older_than)).collect()]
    for some in batched(dropped, PARTITIONS_PER_DROP):
        parts = []
        for spec in some:
            values = {k: unquote(v) for k, v in (part.split("=", 1) for part in spec.split("/"))}
            parts.append(", ".join(f"{quoted(k)} = {text_literal(v)}" for k, v in values.items()))
        which = ", ".join(f"PARTITION ({p})" for p in parts)
        spark.sql(f"ALTER TABLE {table_name(table)} DROP IF EXISTS {which} PURGE")
    return dropped
