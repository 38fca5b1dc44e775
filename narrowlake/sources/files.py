"""Raw drops: which files there are and which of them may be read."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.functions.files import (
    SAMPLE_BYTES,
    ingest_ts,
    looks_like_csv,
    sample_md5,
)

# Globs for .csv in any case, and for the same with files packed by gzip.
CSV_GLOB = "*.[cC][sS][vV]"
GZIP_TOO_GLOB = CSV_GLOB + "{,.[gG][zZ]}"

# Schemes that tasks can open for a ranged read, and the name pyarrow has for them.
RANGED_SCHEMES = {
    "": "file",
    "file": "file",
    "s3": "s3",
    "s3a": "s3",
    "gs": "gs",
    "hdfs": "hdfs",
    "abfs": "abfs",
    "abfss": "abfss",
}


def csv_glob(gzip: bool) -> str:
    return GZIP_TOO_GLOB if gzip else CSV_GLOB


def file_manifest(spark: SparkSession, path: str, gzip: bool = False) -> DataFrame:
    """Non-empty CSV files below ``path``: path, length, modification time.

    Only the listing is read; Spark lists large trees with a job of its own.  ``gzip`` takes
    ``.csv.gz`` files too; their length is the packed one.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", csv_glob(gzip))
        .load(path)
        .select("path", "length", "modificationTime")
        .where(F.col("length") > 0)
    )


# Bytes within which the first record of a file must end; what is longer is no header.
HEADER_BYTES = 8 * 1024 * 1024


def _header_finder():
    """Function from bytes to the first record's text, None if it does not end within them.

    ``whole`` tells that nothing follows the bytes.  Fields that start with a quote end at
    the next one that is not doubled, line ends inside included.  Made here so that it
    travels to tasks by value and the package itself need not be installed there.
    """
    import re

    field = re.compile(rb'"(?:[^"]|"")*"[^,\r\n]*|[^,\r\n"][^,\r\n]*|')

    def header(data: bytes, whole: bool) -> str | None:
        at = 3 if data.startswith(b"\xef\xbb\xbf") else 0
        start = at
        while True:
            if data[at : at + 1] == b'"' and not field.match(data, at).group():
                return None  # the quote is not closed within the bytes
            at = field.match(data, at).end()
            if data[at : at + 1] == b",":
                at += 1
            elif at < len(data) or whole:
                return data[start:at].decode(errors="replace")
            else:
                return None

    return header


def _head_reader(sample: int = SAMPLE_BYTES, most: int = HEADER_BYTES):
    """The task function: first bytes of each file, and its header wherever that ends."""
    header = _header_finder()

    def read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        opened: dict[tuple[str, str], fs.FileSystem] = {}
        for batch in batches:
            heads, headers = [], []
            for path in batch.column("path").to_pylist():
                scheme, _, rest = path.partition(":/")
                scheme, rest = RANGED_SCHEMES[scheme], "/" + rest.lstrip("/")
                if scheme == "file":
                    place, name = "", rest
                else:
                    place, _, name = rest[1:].partition("/")
                    name = f"/{name}" if scheme == "hdfs" else f"{place}/{name}"
                if (scheme, place) not in opened:
                    opened[scheme, place] = (
                        fs.LocalFileSystem()
                        if scheme == "file"
                        else fs.FileSystem.from_uri(f"{scheme}://{place}/")[0]
                    )
                own = opened[scheme, place]
                packed = path.lower().endswith(".gz")
                with own.open_input_stream(name, "gzip") if packed else own.open_input_file(name) as handle:
                    data, asked = handle.read(sample), sample
                    heads.append(data)
                    # Only files whose header does not end yet are read on.
                    while (found := header(data, len(data) < asked)) is None and len(data) == asked < most:
                        data += handle.read(15 * asked)
                        asked *= 16
                    headers.append(found)
            columns = [batch.column(n) for n in ("path", "length", "modificationTime")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(heads, pa.binary()), pa.array(headers, pa.string())],
                ["path", "length", "modificationTime", "head", "header"],
            )

    return read_heads


def _unpacker(most: int = HEADER_BYTES):
    """Function from the first bytes of a gzip file to its first text, and whether that is all of it."""
    import zlib

    def unpacked(data: bytes, whole: bool) -> tuple[bytes, bool]:
        text = b""
        while data and len(text) < most:
            part = zlib.decompressobj(31)
            text += part.decompress(data, most - len(text))
            if not part.eof:
                return text, False
            data = part.unused_data.lstrip(b"\0")
        return text, whole and not data

    return unpacked


def _content_reader(sample: int = SAMPLE_BYTES):
    """The same for contents that Spark has read."""
    header, unpacked = _header_finder(), _unpacker()

    def cut_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("content").to_pylist()
            sizes = batch.column("length").to_pylist()
            for n, path in enumerate(batch.column("path").to_pylist()):
                if path.lower().endswith(".gz"):
                    # Longer than its bytes unless it ends within them, as the length of a plain file is.
                    data[n], ended = unpacked(data[n], len(data[n]) == sizes[n])
                    sizes[n] = len(data[n]) + (not ended)
            columns = [batch.column(n) for n in ("path", "length", "modificationTime")]
            heads = pa.array([d[:sample] for d in data], pa.binary())
            headers = pa.array([header(d, len(d) == n) for d, n in zip(data, sizes)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, heads, headers], ["path", "length", "modificationTime", "head", "header"]
            )

    return cut_heads


HEAD_SCHEMA = "path string, length bigint, modificationTime timestamp, head binary, header string"


def file_heads(spark: SparkSession, path: str, route: str = "auto", gzip: bool = False) -> DataFrame:
    """The manifest with the first bytes and the header of every file.

    ``ranged`` reads nothing but those bytes, and on to the end of a longer header, in the
    tasks that hold the manifest.  ``whole`` goes through Spark's own reader, which loads each file,
    and is for storage that tasks can not open by themselves.
    """
    if route == "auto":
        route = "ranged" if urlsplit(path).scheme in RANGED_SCHEMES else "whole"
    if route == "ranged":
        return with_heads(file_manifest(spark, path, gzip))
    if route != "whole":
        raise ValueError(f"unknown route {route!r}")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", csv_glob(gzip))
        .load(path)
        .where(F.col("length") > 0)
        .select("path", "length", "modificationTime", F.substring("content", 1, HEADER_BYTES).alias("content"))
        .mapInArrow(_content_reader(), HEAD_SCHEMA)
    )


def with_heads(manifest: DataFrame) -> DataFrame:
    """A manifest (path, length, modificationTime) with the first bytes and headers of its files."""
    return manifest.select("path", "length", "modificationTime").mapInArrow(_head_reader(), HEAD_SCHEMA)


def csv_sniff(spark: SparkSession, path: str, route: str = "auto", gzip: bool = False) -> DataFrame:
    """Every file of a drop, its ingest time, fingerprint, header and verdict."""
    return sniffed(file_heads(spark, path, route, gzip))


def sniffed(heads: DataFrame) -> DataFrame:
    return heads.select(
        "path",
        "length",
        "modificationTime",
        ingest_ts(F.col("path")).alias("ingest_ts"),
        sample_md5(F.col("head")).alias("sample_md5"),
        "header",
        looks_like_csv(F.col("head")).alias("is_csv"),
    )


def valid_files(spark: SparkSession, path: str, route: str = "auto", gzip: bool = False) -> DataFrame:
    return csv_sniff(spark, path, route, gzip).where("is_csv").drop("is_csv")
