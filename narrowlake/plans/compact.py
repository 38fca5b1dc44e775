"""Loads packed into larger files, beside readers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.model import COLLECTIONS, Roles
from narrowlake.sinks.store import Store

LOAD_ID = "load_id"
PACKED = "packed-"
# Bytes of a file that packing aims at.
FILE_BYTES = 256 * 1024 * 1024


def records_path(target: str) -> str:
    return target.rstrip("/") + "_packed"


def _state(spark: SparkSession, target: str) -> tuple[int, list[str], list[str]]:
    """Number of the last record, packed loads that count, and loads that these replace."""
    store = Store(spark, records_path(target))
    numbers = sorted((int(e.name) for e in store.list() if e.name.isdigit()), reverse=True)
    for number in numbers:
        try:
            found = json.loads(store.read(f"{number:012d}") or "")
        except ValueError:  # its writer died over it
            continue
        return numbers[0], found["packed"], found["replaced"]
    return numbers[0] if numbers else 0, [], []


def visible(spark: SparkSession, target: str) -> Column:
    """Condition on the load of the rows that count: a filter on a partition column.

    Loads that were packed are left out, and so are packed ones whose run died.
    """
    _, packed, replaced = _state(spark, target)
    own = F.col(LOAD_ID)
    counts = ~own.startswith(PACKED)
    if packed:
        counts = counts | own.isin(packed)
    return counts & ~own.isin(replaced) if replaced else counts


@contextmanager
def _file_size(spark: SparkSession, size: int):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _files(spark: SparkSession, target: str) -> DataFrame:
    """(load_id, folder, length) of all data files, from the listing alone."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target)
    load = F.url_decode(F.regexp_extract("path", f"/{LOAD_ID}=([^/]*)/", 1)).alias(LOAD_ID)
    return found.select(load, F.regexp_replace("path", "/[^/]*$", "").alias("folder"), "length")


def compact(
    spark: SparkSession,
    target: str,
    finished: Sequence[str],
    *,
    schema: T.StructType,
    roles: Roles = COLLECTIONS,
    file_bytes: int = FILE_BYTES,
) -> list[str]:
    """Pack finished loads of small files into one load of larger files; returns the loads packed.

    ``finished`` are loads that will not be written again, ``schema`` that of the stored rows.  Those whose files are less than
    half ``file_bytes`` on average are read and written once more, by series and ingest
    time, under an id of their own; then a record lets the packed rows count and the others
    not.  Readers that planned before read on: the folders of replaced loads are deleted by the
    next call.  A call that dies changes nothing that counts, and what it left is deleted by
    the next one.  One call at a time, under the lease of the ledger.
    """
    number, packed, replaced = _state(spark, target)
    store = Store(spark, records_path(target))
    dead = F.col(LOAD_ID).startswith(PACKED) & ~F.col(LOAD_ID).isin(packed)
    _delete(spark, _files(spark, target).where(F.col(LOAD_ID).isin(replaced) | dead))
    # Listed again now that what does not count is deleted.
    sizes = _files(spark, target).where(F.col(LOAD_ID).isin([*finished, *packed])).groupBy(LOAD_ID).agg(F.avg("length").alias("size"))
    small = {r[0] for r in sizes.where(F.col("size") < file_bytes / 2).collect()} - set(replaced)
    if len(small) < 2:
        chosen, made = [], []
    else:
        chosen, made = sorted(small), [PACKED + uuid4().hex]
        rows = spark.read.schema(schema).parquet(target).where(F.col(LOAD_ID).isin(chosen)).withColumn(LOAD_ID, F.lit(made[0]))
        by = [roles.series, roles.ingest, LOAD_ID]
        with _file_size(spark, file_bytes):
            (
                rows.hint("rebalance", *by)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(*by)
                .parquet(target)
            )
    if not made and not replaced:
        return []
    text = json.dumps({"packed": [p for p in packed if p not in chosen] + made, "replaced": chosen})
    if not store.create(f"{number + 1:012d}", text):
        raise RuntimeError(f"{target} is packed by another run")
    for entry in store.list():
        if entry.name.isdigit() and int(entry.name) <= number:
            store.delete(entry.name)
    return chosen


def _delete(spark: SparkSession, files: DataFrame) -> None:
    """Delete the folders of the files: names of partitions, as any drop of them handles."""
    for (folder,) in files.select("folder").distinct().collect():
        Store(spark, folder).delete()
