"""Token files of independent zstandard frames with a trailing seek table."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import file_system, ship_code, stored, table
from narrowlake.llm.tokens import encoder, vocabulary
from narrowlake.session import work_dir

END_ID = 2
# Tokens after which a frame is closed; a longer document has a frame of its own.
FRAME_TOKENS = 1 << 16
LEVEL = 3
# Words that a worker remembers.
REMEMBERED = 300_000
# Fixed values of the public zstandard formats: skippable frames, seek table and footer.
INDEX_MAGIC, TABLE_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
FOOTER = struct.Struct("<IBI")
HEADER = struct.Struct("<II")
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
# A null doc_id is written as a number no table key can hold apart: a flag of its own.
DOCUMENT = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("tokens", "<u8")])


def write_frames(out, docs: Iterable[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Write documents (doc_id, packed ids) to a binary stream; returns documents and tokens.

    Frames hold whole documents.  Behind them stand a skippable frame with the documents'
    ids and sizes and the seek table: packed size, size and checksum of every frame.
    """
    packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
    entries, index, waiting, held = [], [], [], 0

    def close() -> None:
        nonlocal waiting, held
        data = b"".join(waiting)
        packed = packer.compress(data)
        out.write(packed)
        entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        waiting, held = [], 0

    for doc_id, packed in docs:
        index.append((0 if doc_id is None else doc_id, doc_id is None, len(packed) // 4))
        waiting.append(packed)
        held += len(packed) // 4
        if held >= FRAME_TOKENS:
            close()
    if waiting:
        close()
    index = np.array(index, DOCUMENT)
    block = packer.compress(index.tobytes())
    out.write(HEADER.pack(INDEX_MAGIC, len(block)) + block)
    entries.append((HEADER.size + len(block), 0, 0))
    seek = np.array(entries, ENTRY).tobytes() + FOOTER.pack(len(entries), CHECKSUM_FLAG, FOOTER_MAGIC)
    out.write(HEADER.pack(TABLE_MAGIC, len(seek)) + seek)
    return len(index), int(index["tokens"].sum())


class FrameReader:
    """Reads chosen documents of one file; only their frames are fetched and decompressed."""

    def __init__(self, source, size: int):
        self.source = source
        frames, flag, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != FOOTER_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("not a file of seekable frames with checksums")
        seek = self._at(size - FOOTER.size - frames * ENTRY.itemsize, frames * ENTRY.itemsize)
        self.entries = np.frombuffer(seek, ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["packed"].astype(np.int64))])
        self.tokens = np.concatenate([[0], np.cumsum(self.entries["size"].astype(np.int64) // 4)])
        block = self._at(int(self.starts[frames - 1]) + HEADER.size, int(self.entries["packed"][-1]) - HEADER.size)
        self.unpacker = zstandard.ZstdDecompressor()
        self.documents = np.frombuffer(self.unpacker.decompress(block) if len(block) else b"", DOCUMENT)
        self.ends = np.cumsum(self.documents["tokens"].astype(np.int64))

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        return self.source.read(size)

    def frame(self, number: int) -> bytes:
        entry = self.entries[number]
        data = self.unpacker.decompress(self._at(int(self.starts[number]), int(entry["packed"])))
        if len(data) != entry["size"] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != entry["checksum"]:
            raise ValueError(f"frame {number} does not match its checksum")
        return data

    def read(self, places: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """(place, packed ids) of the documents at these places of the file, all by default."""
        at, data = -1, b""
        for place in range(len(self.documents)) if places is None else sorted(places):
            if not self.documents["tokens"][place]:
                yield place, b""
                continue
            start = int(self.ends[place] - self.documents["tokens"][place])
            number = int(np.searchsorted(self.tokens, start, "right")) - 1
            if number != at:
                at, data = number, self.frame(number)
            low = 4 * (start - int(self.tokens[number]))
            yield place, data[low : low + 4 * int(self.documents["tokens"][place])]


def write_tokens(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode whole texts and write one file per range of doc_id; returns the list of files.

    The list holds (part, path, documents, tokens, start); start is the number of ids in all
    files before.  Documents stand in ascending doc_id order, null first, rows of one id
    by a hash of their text.  A task that is run again writes a file of another name, and
    only files of the list count.  Null texts are empty and hold the end id alone.  Without
    documents the list is empty.
    """
    ship_code(docs.sparkSession)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary_path, REMEMBERED).packed
        end = np.uint32(end_id).tobytes()
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return

        def packed():
            for batch in _chain(first, batches):
                for doc_id, text in zip(batch["doc_id"], batch["text"]):
                    yield None if pd.isna(doc_id) else int(doc_id), encode(text) + end

        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        store, place = file_system(path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        with store.open_output_stream(place, compression=None) as out:
            documents, tokens = write_frames(out, packed())
        yield pd.DataFrame({"part": [part], "path": [path], "documents": [documents], "tokens": [tokens]})

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    files = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    files = files.mapInPandas(write, "part int, path string, documents long, tokens long")
    return stored(files, "token-files").withColumn("start", F.expr("sum(tokens) OVER (ORDER BY part) - tokens"))


def _chain(first: pd.DataFrame, rest: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield first
    yield from rest


def read_tokens(files: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) of the listed files: all documents, or those of a short list of ids."""
    return _read(files, doc_ids, "ids binary", lambda ids: ids)


def read_digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files' ids."""
    rows = _read(files, None, "ids_crc32 long", zlib.crc32)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def _read(files: DataFrame, doc_ids: list[int] | None, column: str, made) -> DataFrame:
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), np.int64)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"]):
                store, place = file_system(path)
                with store.open_input_file(place) as source:
                    reader = FrameReader(source, source.size())
                    documents, ends = reader.documents, reader.ends
                    places = None
                    if wanted is not None:
                        places = np.flatnonzero(np.isin(documents["doc_id"], wanted) & (documents["null"] == 0)).tolist()
                    rows = []
                    for at, ids in reader.read(places):
                        own = documents[at]
                        doc_id = None if own["null"] else int(own["doc_id"])
                        rows.append((doc_id, int(start + ends[at] - own["tokens"]), int(own["tokens"]), made(ids)))
                        if len(rows) == 2_000:
                            yield _frame(rows, column)
                            rows = []
                    if rows:
                        yield _frame(rows, column)

    # One file is one unit of work, however short its row.
    count = max(1, files.count())
    return files.select("path", "start").repartition(count).mapInPandas(
        read, f"doc_id long, start long, n_tokens long, {column}"
    )


def _frame(rows: list[tuple], column: str) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", column.split()[0]])
    return out.astype({"doc_id": "Int64"})


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = work_dir(spark, "tokens")
    files = write_tokens(table(spark, folder, "documents"), target, vocabulary("byte_bpe_50k.json"))
    return read_digests(files)
