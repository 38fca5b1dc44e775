"""Small helpers the operators share: tables, stored steps, unused column names."""

from __future__ import annotations

import contextlib
import functools
import gc
import io
import pathlib
import posixpath
import urllib.parse
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as arrow
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.session import work_dir

# Words of texts end at ASCII white space only.
SPACED_WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The store of a path or URI and the path in it, as the machine that asks can reach it."""
    if ":/" not in uri:
        return arrow_fs.LocalFileSystem(), uri
    scheme, _, rest = uri.partition(":")
    scheme = "s3" if scheme == "s3a" else scheme
    return arrow_fs.FileSystem.from_uri(f"{scheme}:{rest if rest.startswith('//') else '//' + rest}")


def ship_code(spark: SparkSession) -> None:
    """Give this package to the tasks, once per application, wherever it is installed or not."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = pathlib.Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    path = posixpath.join(work_dir(spark, "code"), f"{package.name}.zip")
    store, place = file_system(path)
    store.create_dir(posixpath.dirname(place), recursive=True)
    with store.open_output_stream(place, compression=None) as out:
        out.write(held.getvalue())
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(posixpath.join(folder, f"{name}.parquet"))


# Lists that ``stored`` enters its tables in, the innermost last.
_LISTS: list[list[str]] = []
# Tables of earlier pipeline stages of this process.
_LEFT: list[str] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder all executors share and read again.

    This cuts the lineage at files that outlive any executor, and makes later
    passes read what an expensive step made instead of repeating it.
    """
    ship_code(df.sparkSession)
    path = work_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    if _LISTS:
        _LISTS[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop(table_of: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    _delete(table_of.sparkSession, table_of.stored_at)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end every table stored inside, but for those handed to what this yields.

    Nothing lazy that reads the others may leave the block.  If it fails they stay, as
    other tasks may still be at them.
    """
    mine: list[str] = []
    kept: list[str] = []

    def keep(table_of: DataFrame) -> DataFrame:
        kept.append(table_of.stored_at)
        return table_of

    _LISTS.append(mine)
    try:
        yield keep
    finally:
        _LISTS.pop()
        if _LISTS:
            _LISTS[-1].extend(mine)
    for path in set(mine) - set(kept):
        _delete(spark, path)
        if _LISTS:
            _LISTS[-1].remove(path)
    free(spark)


def free(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of what is not referred to any more; it learns so from the collectors."""
    gc.collect()
    spark._jvm.System.gc()


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A pipeline stage that first deletes the tables of earlier ones, whose results are stored by then.

    Tables that its documents are still to be read from stay.  What a cache that may not be
    filled yet is made of can not be told, so all stay for documents that are cached.
    """

    @functools.wraps(work)
    def staged(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        cached = "InMemoryRelation" in docs._jdf.queryExecution().optimizedPlan().toString()
        if _LEFT and not cached:
            read = {urllib.parse.urlsplit(f).path for f in docs.inputFiles()}
            for path in list(_LEFT):
                if not any(f.startswith(urllib.parse.urlsplit(path).path.rstrip("/") + "/") for f in read):
                    _delete(spark, path)
                    _LEFT.remove(path)
            free(spark)
        mine: list[str] = []
        _LISTS.append(mine)
        try:
            return work(spark, docs, folder)
        finally:
            _LISTS.pop()
            _LEFT.extend(mine)

    return staged


# What the operators of one Python worker remember, by the module that remembers it.
_MEMORIES: dict[str, list[Callable[[], None]]] = {}


def remembers(owner: str, forget: Callable[[], None]) -> None:
    """Name a way to drop what a module remembers between the tasks of a worker."""
    _MEMORIES.setdefault(owner, []).append(forget)


def only_memory_of(owner: str) -> None:
    """Drop what other operators left in this worker, which serves the tasks of all of them."""
    for other, ways in _MEMORIES.items():
        if other != owner:
            for forget in ways:
                forget()
    arrow.default_memory_pool().release_unused()


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand so many rows to Python at a time in the actions inside: for rows of many kilobytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other letter alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo the folds; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def valid_vectors(vector: str) -> Column:
    """True for vectors that are neither null, empty nor zero and hold finite numbers only."""
    v = F.col(vector)
    broken = F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")).cast("double"))
    )
    return F.coalesce(v.isNotNull() & ~broken & F.exists(v, lambda x: x != 0), F.lit(False))


def task_count(rows: int, per_task: int, least: int) -> int:
    """Number of groups so that each holds about ``per_task`` rows."""
    return max(least, -(-rows // per_task))
