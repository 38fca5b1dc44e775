"""CSV readers, each row stamped with the ingest time of its own file."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from narrowlake.functions.files import file_path, ingest_ts
from narrowlake.model import COLLECTIONS, Roles
from narrowlake.sources.files import CSV_GLOB, csv_glob

# Reader options of the loader.
STRICT_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "DROPMALFORMED",
}

SOURCE_FILE = "source_file"
# The ingest time that a row's file has, where it was found once for the file.
FILE_INGEST = "file_ingest"

# The text of a line whose number of fields is not that of its file's header.
MALFORMED = "malformed_line"


def strict_options(multiline: bool = True) -> dict[str, str]:
    """``multiline=False`` lets Spark split large files, for drops known to have
    no line breaks inside quotes."""
    return {**STRICT_OPTIONS, "multiLine": str(multiline).lower()}


def read_csv_strict(
    spark: SparkSession,
    paths: str | Sequence[str],
    roles: Roles = COLLECTIONS,
    *,
    schema: T.StructType | None = None,
    infer: bool = False,
    multiline: bool = True,
) -> DataFrame:
    """Rows of well-formed lines; short lines are dropped, quoting is honoured.

    Columns are taken by position: for files known to have one layout.  Loads use
    ``read_by_header``.  The schema is all strings unless given.  ``infer`` reads the files once more
    and lets any odd value decide the type of a column.
    """
    reader = spark.read.options(**strict_options(multiline))
    reader = reader.options(recursiveFileLookup=True, pathGlobFilter=CSV_GLOB)
    reader = reader.option("inferSchema", True) if infer else reader.schema(schema or roles.csv_schema())
    return _with_source(reader.csv(paths if isinstance(paths, str) else list(paths)))


LAYOUT_SCHEMA = (
    "path string, modificationTime timestamp, width int, places array<int>, others array<string>,"
    " other_places array<int>, problem string"
)
# Bytes of the layouts of a load's files up to which they are sent to all tasks.
MOST_SENT = 64 * 1024 * 1024


class MissingFiles(FileNotFoundError):
    """Files that were to be read are not there any more, or are others."""


def _layout_reader(wanted: Sequence[str], needed: Sequence[str], multiline: bool):
    """The task function: what each file's header says, made here so that it travels by value."""
    wanted, needed = list(wanted), list(needed)

    def layouts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv

        import pandas as pd

        for batch in batches:
            rows = []
            for path, time, header in zip(batch["path"], batch["modificationTime"], batch["header"]):
                names = [n.strip() for n in next(csv.reader([header or ""], strict=False), [])]
                folded = [n.lower() for n in names]
                repeated = sorted({n for n in folded if folded.count(n) > 1})
                missing = [c for c in needed if c.lower() not in folded]
                if not names:
                    problem = "the header does not end"
                elif repeated:
                    problem = f"repeated column {repeated[0]!r}"
                elif missing:
                    problem = f"no column {missing[0]!r}"
                elif not multiline and ("\n" in header or "\r" in header):
                    problem = "the header has several lines"
                else:
                    problem = None
                place = {n: i for i, n in enumerate(folded)}
                others = [] if problem else [n for n in names if n.lower() not in {c.lower() for c in wanted}]
                rows.append(
                    (
                        path,
                        time,
                        len(names),
                        [place.get(c.lower()) for c in wanted],
                        others,
                        [place[n.lower()] for n in others],
                        problem,
                    )
                )
            names = "path modificationTime width places others other_places problem".split()
            yield pd.DataFrame(rows, columns=names)

    return layouts


def layouts(files: DataFrame, roles: Roles = COLLECTIONS, *, multiline: bool = True) -> DataFrame:
    """For each sniffed file the number of its columns, the place of each column of the roles, NULL
    if it lacks it, other columns with their places, and why it can not be read, if so."""
    needed = (*roles.keys, roles.item, roles.value)
    return files.select("path", "modificationTime", "header").mapInPandas(
        _layout_reader(roles.columns, needed, multiline), LAYOUT_SCHEMA
    )


def _same_path(path: Column) -> Column:
    """Listings and row metadata differ in the slashes behind the scheme."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def _folders(found: DataFrame) -> list[str]:
    """Folders that hold the files, without those below another; as many as drops, not files."""
    folders = sorted(r[0] for r in found.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect())
    out: list[str] = []
    for folder in folders:
        if not any(folder.startswith(above + "/") for above in out[-1:]):
            out.append(folder)
    return out


def read_by_header(
    spark: SparkSession,
    files: DataFrame,
    roles: Roles = COLLECTIONS,
    *,
    multiline: bool = True,
    extra: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Rows of sniffed files, columns taken by the names in each file's own header.

    What the headers say is data: the folders of the files are scanned once for each number
    of columns, files last written outside the span of the wanted ones are left out by the
    listing, and rows meet the layout of their file in a join, so no list of files
    passes through the driver.  Layouts are sent to all tasks as long as they are
    MOST_SENT bytes at most; beyond that, rows go to them.  Where all files of a number of
    columns have one layout, other columns are not taken out of their lines.

    Columns may stand in any order; optional ones that a file lacks are NULL; others are left
    out unless ``extra`` asks for them.  Lines with too few or too many fields keep their text
    in ``malformed_line``.  Files without a column they need, or whose header has no end,
    are not read: they are the second result (path, problem).  Files that are gone or were
    written again since they were sniffed raise.
    """
    columns = list(roles.columns)
    found = layouts(files, roles, multiline=multiline).persist()
    good = found.where("problem IS NULL")
    refused = found.where("problem IS NOT NULL").select("path", "problem")
    spans = good.groupBy("width").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.length("path") + 4 * (F.size("places") + F.size("other_places")) + 64).alias("bytes"),
        F.date_format(F.min("modificationTime") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss").alias("after"),
        F.date_format(F.max("modificationTime") + F.expr("INTERVAL 2 SECOND"), "yyyy-MM-dd'T'HH:mm:ss").alias("before"),
        F.min("places").alias("places"),
        (F.min("places") == F.max("places")).alias("alike"),
        F.bool_or(F.lower("path").endswith(".gz")).alias("gzip"),
    )
    others: dict[str, str] = {}
    if extra:
        for (name,) in good.select(F.explode("others")).distinct().orderBy("col").collect():
            others.setdefault(name.lower(), name)
    parts = []
    for span in spans.orderBy("width").collect():
        of_width = good.where(F.col("width") == span["width"])
        fields = [T.StructField(f"_{n}", T.StringType()) for n in range(span["width"])]
        folders = _folders(of_width)
        there = _there(spark, of_width, folders, span["gzip"])
        rows = (
            spark.read.options(**strict_options(multiline))
            .options(mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED)
            .options(recursiveFileLookup=True, pathGlobFilter=csv_glob(span["gzip"]))
            .options(modifiedAfter=span["after"], modifiedBefore=span["before"])
            .schema(T.StructType([*fields, T.StructField(MALFORMED, T.StringType())]))
            .csv(folders)
        )
        layout = there.select("_uri", SOURCE_FILE, FILE_INGEST, "places", "others", "other_places")
        if span["bytes"] <= MOST_SENT:
            layout = F.broadcast(layout)
        rows = rows.select("*", F.col("_metadata.file_path").alias("_uri")).join(layout, "_uri")
        values = F.array(*[f"_{n}" for n in range(span["width"])])
        if span["alike"]:
            own = [F.lit(None).cast("string") if at is None else F.col(f"_{at}") for at in span["places"]]
        else:
            own = [F.get(values, F.get("places", F.lit(n))) for n in range(len(columns))]
        lower = F.transform("others", F.lower)
        parts.append(
            rows.select(
                *[value.alias(c) for value, c in zip(own, columns)],
                *[
                    F.get(values, F.get("other_places", F.array_position(lower, low).cast("int") - 1)).alias(name)
                    for low, name in others.items()
                ],
                MALFORMED,
                SOURCE_FILE,
                FILE_INGEST,
            )
        )
    if not parts:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, MALFORMED, SOURCE_FILE, FILE_INGEST)])
        return spark.createDataFrame([], schema), refused
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), refused


def _there(spark: SparkSession, wanted: DataFrame, folders: Sequence[str], gzip: bool) -> DataFrame:
    """The wanted files with their names as rows have them; raises if a listing does not show one as it was sniffed."""
    uri = F.col("_metadata.file_path")
    listed = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=csv_glob(gzip))
        .load(folders)
        .select(
            _same_path(F.col("path")).alias("_file"),
            F.col("modificationTime").alias("_time"),
            uri.alias("_uri"),
            file_path(uri).alias(SOURCE_FILE),
        )
        .withColumn(FILE_INGEST, ingest_ts(F.col(SOURCE_FILE)))
    )
    same = (_same_path(F.col("path")) == F.col("_file")) & (F.col("modificationTime") == F.col("_time"))
    found = wanted.join(listed, same, "left").persist()
    gone = found.where("_uri IS NULL").select("path").head(3)
    if gone:
        raise MissingFiles(f"changed or gone since they were listed: {[r[0] for r in gone]}")
    return found


def read_csv_plain(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Header and inferred types only; malformed lines are kept."""
    return (
        spark.read.options(header=True, inferSchema=True, recursiveFileLookup=True)
        .option("pathGlobFilter", CSV_GLOB)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def _with_source(rows: DataFrame) -> DataFrame:
    return rows.select("*", file_path(F.col("_metadata.file_path")).alias(SOURCE_FILE))


def stamp_ingest(
    rows: DataFrame,
    roles: Roles = COLLECTIONS,
    *,
    mode: str = "per_file",
    files: DataFrame | None = None,
) -> DataFrame:
    """Add the ingest time, by default that of the file a row comes from.

    ``first_file`` gives every row the time of the first of ``files`` in name
    order instead.
    """
    if mode == "per_file":
        stamp = F.col(FILE_INGEST) if FILE_INGEST in rows.columns else ingest_ts(F.col(SOURCE_FILE))
    elif mode == "first_file":
        if files is None:
            raise ValueError("first_file needs the files of the load")
        first = files.agg(F.min("path").alias("path")).select(ingest_ts(F.col("path"))).first()[0]
        stamp = F.lit(first)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return rows.withColumn(roles.ingest, stamp)
