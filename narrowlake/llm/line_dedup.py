"""Repeated lines dropped from texts: two Bloom filters choose the lines that are looked at exactly."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import ship_code, small_batches, stored, table, task_count

# Code points that a line's key has at least to be looked at.
LEAST = 10
BLANK = b" \t\n\x0b\x0c\r"
# Bytes of the digest that stands for a key.
DIGEST = 16
# Lines of one block of documents, and hashes that one pair of filters holds, about.
BLOCK_LINES = 200_000
FILTER_LINES = 2_000_000
LEAST_FILTERS = 24
# Bits of a filter for each hash, at least, and bits that a hash sets.
BITS, PROBES = 10, 5
TEXT_ROWS = 2_000


def line_key(line: bytes) -> bytes | None:
    """The key of a line, stripped and lower-cased; None for one too short to be looked at."""
    key = line.strip(BLANK).lower()
    if len(key) < LEAST or (len(key) < 4 * LEAST and len(key.decode()) < LEAST):
        return None
    return key


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=DIGEST).digest()


class Bloom:
    """Bits set by 64-bit hashes: it never denies one that was added."""

    def __init__(self, hashes: int):
        self.bits = 1 << max(10, int(BITS * hashes - 1).bit_length())
        self.words = np.zeros(self.bits // 8, np.uint8)

    def _places(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for probe in range(PROBES):
            bit = (hashes + np.uint64(probe) * step) & np.uint64(self.bits - 1)
            yield (bit >> np.uint64(3)).astype(np.int64), np.left_shift(1, (bit & np.uint64(7)).astype(np.uint8), dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for word, bit in self._places(hashes):
            np.bitwise_or.at(self.words, word, bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for word, bit in self._places(hashes):
            out &= (self.words[word] & bit) > 0
        return out


def blocks(docs: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Stored blocks of documents: ids, numbers of distinct keys, and the keys' digests."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() << 24
        ids, sizes, parts, held = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = {digest(k) for k in map(line_key, text.encode().split(b"\n")) if k is not None}
                if not own:
                    continue
                ids.append(doc_id)
                sizes.append(len(own))
                parts.append(b"".join(sorted(own)))
                held += len(own)
                if held >= block_lines:
                    yield _block(number, ids, sizes, parts)
                    ids, sizes, parts, held, number = [], [], [], 0, number + 1
        if ids:
            yield _block(number, ids, sizes, parts)

    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "block long, lines long, ids binary, sizes binary, digests binary"
    with small_batches(docs.sparkSession, TEXT_ROWS):
        return stored(rows.mapInPandas(made, schema), "line-blocks")


def _block(number: int, ids: list[int], sizes: list[int], parts: list[bytes]) -> pd.DataFrame:
    row = {
        "block": number,
        "lines": sum(sizes),
        "ids": np.array(ids, np.int64).tobytes(),
        "sizes": np.array(sizes, np.int64).tobytes(),
        "digests": b"".join(parts),
    }
    return pd.DataFrame([row])


def _lines(row) -> tuple[np.ndarray, np.ndarray]:
    """The document and the digest, as two numbers, of every line of a block."""
    ids, sizes = np.frombuffer(row.ids, np.int64), np.frombuffer(row.sizes, np.int64)
    return np.repeat(ids, sizes), np.frombuffer(row.digests, np.uint64).reshape(-1, 2)


def _sender(filters: int):
    def sent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds = np.array([n * 2**64 // filters for n in range(filters)], np.uint64)
        for batch in batches:
            for row in batch.itertuples():
                ids, digests = _lines(row)
                order = np.argsort(digests[:, 0], kind="stable")
                hashes, ids = digests[order, 0], ids[order]
                starts = np.flatnonzero(np.diff(hashes, prepend=hashes[0] ^ np.uint64(1)))
                # A hash that two documents of the block have is sent as a repeated one.
                repeated = np.minimum.reduceat(ids, starts) < np.maximum.reduceat(ids, starts)
                hashes = hashes[starts]
                cuts = np.append(np.searchsorted(hashes, bounds), len(hashes)).tolist()
                rows = []
                for n in range(filters):
                    if cuts[n] < cuts[n + 1]:
                        mine, twice = hashes[cuts[n] : cuts[n + 1]], repeated[cuts[n] : cuts[n + 1]]
                        rows.append((n, row.block, mine[~twice].tobytes(), mine[twice].tobytes()))
                yield pd.DataFrame(rows, columns=["part", "block", "single", "repeated"])

    return sent


def suspects(rows: pd.DataFrame) -> pd.DataFrame:
    """To each block of one range of hashes those of its hashes that may be repeated.

    A hash that the filter of once-seen ones already has goes to the filter of twice-seen ones,
    which then answers.  A filter may take a line for repeated that is not, never the
    other way round.
    """
    sizes = sum(len(x) + len(y) for x, y in zip(rows["single"], rows["repeated"])) // 8
    once, twice = Bloom(sizes), Bloom(sizes)
    out = []
    for single, repeated in zip(rows["single"], rows["repeated"]):
        single, repeated = np.frombuffer(single, np.uint64), np.frombuffer(repeated, np.uint64)
        twice.add(repeated)
        twice.add(single[once.has(single)])
        once.add(single)
        once.add(repeated)
    for block, single, repeated in zip(rows["block"], rows["single"], rows["repeated"]):
        single = np.frombuffer(single, np.uint64)
        out.append((block, single[twice.has(single)].tobytes() + repeated))
    return pd.DataFrame(out, columns=["block", "hashes"])


def _suspected(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(digest, block, low, high): suspected lines once for each block, with its smallest and largest document."""
    for batch in batches:
        for row in batch.itertuples():
            asked = np.unique(np.frombuffer(b"".join(row.hashes), np.uint64))
            ids, digests = _lines(row)
            mine = np.isin(digests[:, 0], asked)
            ids, digests = ids[mine], digests[mine]
            order = np.lexsort((ids, digests[:, 1], digests[:, 0]))
            ids, digests = ids[order], digests[order]
            new = np.ones(len(ids), bool)
            new[1:] = (digests[1:] != digests[:-1]).any(1)
            starts = np.flatnonzero(new)
            packed = digests[starts].tobytes()
            yield pd.DataFrame(
                {
                    "digest": [packed[i : i + DIGEST] for i in range(0, len(packed), DIGEST)],
                    "block": row.block,
                    "low": ids[starts],
                    "high": ids[np.append(starts[1:], len(ids)) - 1],
                }
            )


def _dropped(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, gone): digests of the lines that each document of a block loses."""
    first = dict(zip(answers["digest"], answers["first"]))
    rows = []
    if first:
        for row in block.itertuples():
            at = 0
            for doc_id, size in zip(np.frombuffer(row.ids, np.int64).tolist(), np.frombuffer(row.sizes, np.int64).tolist()):
                own = [row.digests[i : i + DIGEST] for i in range(at, at + DIGEST * size, DIGEST)]
                gone = b"".join([d for d in own if first.get(d, doc_id) < doc_id])
                at += DIGEST * size
                if gone:
                    rows.append((doc_id, gone))
    return pd.DataFrame(rows, columns=["doc_id", "gone"])


def repeated_lines(docs: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """(doc_id, gone): the digests, 16 bytes each, of the lines that a document loses, if any."""
    ship_code(docs.sparkSession)
    cut = blocks(docs, block_lines)
    lines = cut.agg(F.sum("lines")).first()[0] or 0
    sent = cut.mapInPandas(_sender(task_count(lines, FILTER_LINES, LEAST_FILTERS)), "part int, block long, single binary, repeated binary")
    asked = sent.groupBy("part").applyInPandas(suspects, "block long, hashes binary")
    asked = asked.where(F.length("hashes") > 0).groupBy("block").agg(F.collect_list("hashes").alias("hashes"))
    seen = cut.join(asked, "block").mapInPandas(_suspected, "digest binary, block long, low long, high long")
    seen = stored(seen, "suspected-lines")
    first = seen.groupBy("digest").agg(F.min("low").alias("first"), F.max("high").alias("last")).where("first < last")
    answers = seen.join(first, "digest").where("high > first").select("block", "digest", "first")
    return cut.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_dropped, "doc_id long, gone binary")


def without_repeated_lines(docs: DataFrame, block_lines: int = BLOCK_LINES) -> DataFrame:
    """The documents with ``line_count``, ``lines_dropped`` and ``kept_text``.

    A text is split at line feeds; a line's key is the line without ASCII white space at
    both ends, A-Z lower-cased.  Keys of 10 or more code points that stand in two documents
    or more lose all their lines except those of the smallest doc_id that holds them, all
    of which stay.  kept_text holds the lines that stay.

    Documents file the digests of their keys in blocks.  64 bits of each go, once for a
    block, to filters dealt by ranges of hashes, whose number follows that of the lines; only
    lines that these suspect are compared, by digests of 128 bits, once for a block again.
    A line that stands in every document is one row of each block.  What a document loses
    is joined to it by its id.

    Null and empty texts are one empty line, which stays.  Rows with the same doc_id are one
    document.  Rows without an id keep all lines and let no other lose any.  Existing columns
    of the three names are replaced, others stay; an empty table gives an empty result.
    """
    gone = repeated_lines(docs, block_lines).groupBy("doc_id").agg(F.collect_list("gone").alias("_gone"))
    gone = gone.select(F.col("doc_id").alias("_gone_from"), "_gone")

    @F.pandas_udf("lines long, dropped long, kept string")
    def cut(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
        rows = []
        for text, own in zip(texts, gone):
            lines = (text or "").encode().split(b"\n")
            if own is None:
                rows.append((len(lines), 0, text or ""))
                continue
            own = b"".join(own)
            own = {own[i : i + DIGEST] for i in range(0, len(own), DIGEST)}
            keys = map(line_key, lines)
            kept = [line for line, key in zip(lines, keys) if key is None or digest(key) not in own]
            rows.append((len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
        return pd.DataFrame(rows, columns=["lines", "dropped", "kept"])

    joined = docs.join(gone, F.col("doc_id") == F.col("_gone_from"), "left")
    joined = joined.withColumn("_cut", cut("text", "_gone"))
    return joined.withColumns(
        {
            "line_count": F.col("_cut.lines"),
            "lines_dropped": F.col("_cut.dropped"),
            "kept_text": F.col("_cut.kept"),
        }
    ).drop("_cut", "_gone", "_gone_from")


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = without_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("line_count").alias("n_lines"),
        F.col("lines_dropped").alias("n_dropped"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


SQL = """
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
  SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM cut
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first FROM keyed
  WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
  SELECT k.*, coalesce(f.first <> k.doc_id, false) AS gone FROM keyed k LEFT JOIN firsts f USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
