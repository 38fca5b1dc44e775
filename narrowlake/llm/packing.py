"""Best-two-fit packing of token pieces into sequences of a fixed length."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as arrow
from pyarrow import parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import (
    file_system,
    only_memory_of,
    ship_code,
    small_batches,
    stored,
    table,
    task_count,
)
from narrowlake.llm.tokens import encoder, vocabulary

LENGTH = 2_048
END_ID = 0
# Pieces that one call packs.  A call ends with at most a few loosely filled sequences.
CALL_PIECES = 8_192
# Texts that a task hands to Python at a time.
TEXT_ROWS = 2_000
# Pieces with ids that a task hands back at a time.
PIECE_ROWS = 500
# Words that a worker remembers where packing is all it does.
REMEMBERED = 300_000


def pieces(
    docs: DataFrame,
    vocabulary_path: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    ids: bool = False,
    remembered: int | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document, in rows of at most ``length`` ids.

    A document is the ids of its whole text and then the end id; only longer documents are
    cut.  Null texts are empty; a document has one id at least.  ``ids`` also returns the ids
    as little-endian 32-bit numbers.  Equal rows give equal pieces each; a null doc_id
    stays null.
    """
    ship_code(docs.sparkSession)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary_path, remembered).packed
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                packed = encode(text) + end
                for n, at in enumerate(range(0, len(packed), 4 * length)):
                    own = packed[at : at + 4 * length]
                    rows.append((doc_id, n, at // 4, len(own) // 4, zlib.crc32(own), own)[: 5 + ids])
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text")).mapInPandas(cut, schema)


def pack(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """The pieces with sequence_id and offset: where each stands in which sequence.

    Pieces are dealt evenly over calls by their place in the stored files, whatever their
    ids, and each call packs its own: a sequence is filled with the longest pieces that
    fit; then, as long as it gets fuller, its shortest piece is exchanged for the two
    waiting pieces that fill the room tightest.  Every piece is placed once, offsets have
    no gaps.  No pieces give no rows.  Ids stay in the stored files: their pieces are packed
    by length, and the places are brought to the files.
    """
    with small_batches(cut.sparkSession, TEXT_ROWS):
        rows = stored(cut, "pieces")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    calls = task_count(rows.count(), CALL_PIECES, 1)
    call = F.pmod(F.xxhash64("row"), F.lit(calls).cast("long")).alias("call")
    if "ids" not in cut.columns:
        return _placed(rows.select(*cut.columns, call), cut.columns, length)
    at = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")]
    return _beside(rows, _placed(rows.select(*at, "length", call), ["file", "at", "length"], length), cut.columns)


def _placed(rows: DataFrame, names: list[str], length: int) -> DataFrame:
    """These columns of the pieces of each call, with sequence_id and offset."""
    schema = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        only_memory_of("packing")
        sequence, offset = best_two_fit(rows["length"].to_numpy(), length)
        call = int(rows["call"].iloc[0])
        return rows[names].assign(sequence_id=sequence + (call << 32), offset=offset)

    return rows.groupBy("call").applyInPandas(place, schema + ", sequence_id long, offset long")


def _beside(rows: DataFrame, placed: DataFrame, names: list[str]) -> DataFrame:
    """Stored pieces with their places; the places go to the files, so that no ids are shuffled.

    One file is one unit of work: it holds the pieces of one task that cut documents.
    """
    schema = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)

    def read(batches: Iterator[arrow.RecordBatch]) -> Iterator[arrow.RecordBatch]:
        only_memory_of("packing")
        for batch in batches:
            for file, places in zip(batch["file"], batch["places"]):
                order = np.argsort(places.values.field("at").to_numpy())
                own = [places.values.field(n).to_numpy()[order] for n in ("sequence_id", "offset")]
                store, path = file_system(file.as_py())
                done = 0
                with store.open_input_file(path) as source:
                    stream = parquet.ParquetFile(source, buffer_size=1 << 20)
                    for part in stream.iter_batches(PIECE_ROWS, columns=names):
                        upto = done + len(part)
                        beside = [arrow.array(x[done:upto]) for x in own]
                        yield arrow.RecordBatch.from_arrays([*part.columns, *beside], [*names, "sequence_id", "offset"])
                        done = upto

    count = max(1, rows.select("_metadata.file_path").distinct().count())
    files = placed.groupBy("file").agg(F.collect_list(F.struct("at", "sequence_id", "offset")).alias("places"))
    return files.repartition(count).mapInArrow(read, schema + ", sequence_id long, offset long")


def best_two_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; no piece may be longer than the room."""
    waiting: list[list[int]] = [[] for _ in range(room + 1)]
    for row, size in enumerate(lengths.tolist()):
        waiting[size].append(row)
    counts = np.array([len(w) for w in waiting])
    # at_most[x]: the longest waiting size that is at most x, 0 for none.
    at_most = np.maximum.accumulate(np.where(counts > 0, np.arange(room + 1), 0))

    def change(size: int, by: int) -> None:
        counts[size] += by
        if counts[size] == max(by, 0):  # the size came or went
            longer = np.flatnonzero(counts[size + 1 :])
            until = size + 1 + longer[0] if len(longer) else room + 1
            at_most[size:until] = size if by > 0 else at_most[size - 1]

    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0
    while at_most[room]:
        bin_sizes, gap = [], room
        while at_most[gap]:
            size = int(at_most[gap])
            bin_sizes.append(size)
            change(size, -1)
            gap -= size
        while gap and len(bin_sizes) > 1:
            least = min(bin_sizes)
            size, other = _two(counts, at_most, gap + least)
            if size + other <= least:
                break
            bin_sizes.remove(least)
            bin_sizes += [size, other]
            change(size, -1)
            change(other, -1)
            change(least, 1)
            gap += least - size - other
        at = 0
        for size in bin_sizes:
            row = waiting[size].pop()
            sequence[row], offset[row] = number, at
            at += size
        number += 1
    return sequence, offset


def _two(counts: np.ndarray, at_most: np.ndarray, room: int) -> tuple[int, int]:
    """The two waiting sizes with the largest sum that fits; zeros if there are none."""
    first = np.flatnonzero(counts[:room])
    if not len(first):
        return 0, 0
    second = at_most[room - first]
    lone = (second == first) & (counts[first] < 2)
    second = np.where(lone, at_most[first - 1], second)
    total = np.where(second > 0, first + second, 0)
    best = int(total.argmax())
    return (int(first[best]), int(second[best])) if total[best] else (0, 0)


def op6_pack(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pack(pieces(docs, vocabulary("word_bpe_49k.json"), remembered=REMEMBERED))
