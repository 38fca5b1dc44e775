"""Tokens of two tokenizers aligned by the byte offsets where both end."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from narrowlake.llm.common import only_memory_of, ship_code, small_batches, stored, table
from narrowlake.llm.tokens import byte_letters, vocabulary

# Links of one block of documents, about, and texts that a task hands to Python at a time.
BLOCK_LINKS = 1_500_000
TEXT_ROWS = 1_000
# An id pair is one number: ids of the first tokenizer times this plus those of the second.
PAIR = 1 << 24
# A group of more links is counted by its distinct ids.
WIDE_GROUP = 10_000
# Runs of white space from which on the faster library gives up.
WIDE_BLANK = 5_000
_WIDE_BLANK = re.compile(rf"\s{{{WIDE_BLANK}}}")
# Fixed value: the pattern of pre-tokens of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def group_ends(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """Behind which tokens the groups end in two lists of ascending ends, whose last ones are equal.

    As long as the ends at the current shift of places are equal, groups are one-to-one: how
    far is found by comparing 1, 2, 4, ... ends at a time and halving behind the first
    difference.  An irregular group ends at the next common end, which sets the shift.
    """
    left: list[int] = []
    right: list[int] = []
    i = j = 0
    size = len(a)
    while i < size:
        if a[i] == b[j]:
            run, width = 1, 2
            while a[i + run : i + run + width] == b[j + run : j + run + width]:
                run += width
                width *= 2
                if i + run >= size:
                    break
            else:
                while width > 1:
                    width //= 2
                    if a[i + run : i + run + width] == b[j + run : j + run + width]:
                        run += width
            run = min(run, size - i)
            left += range(i + 1, i + run + 1)
            right += range(j + 1, j + run + 1)
            i += run
            j += run
            continue
        p, q = a[i], b[j]
        while p != q:
            if p < q:
                i += 1
                p = a[i]
            else:
                j += 1
                q = b[j]
        i += 1
        j += 1
        left.append(i)
        right.append(j)
    return left, right


class Pair:
    """A byte-level vocabulary and a sentencepiece model, with the bytes of their ids."""

    def __init__(self, first: str, second: str):
        self.library = Tokenizer.from_file(first)
        self.library.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=second)
        letters = {letter: byte for byte, letter in byte_letters().items()}
        vocabulary, special = self.library.get_vocab(), self.library.get_added_tokens_decoder()
        size = max(vocabulary.values()) + 1
        self.a_bytes = [b""] * size
        for name, i in vocabulary.items():
            if i not in special:
                self.a_bytes[i] = bytes([letters[c] for c in name])
        self.b_bytes = [self._piece(i) for i in range(self.second.get_piece_size())]
        self.a_sizes, self.b_sizes = ([len(t) for t in own] for own in (self.a_bytes, self.b_bytes))
        # The text of each id within a group and at its end.
        self.a_told = np.array([f"{i}{c}" for i in range(size) for c in ",|"], object)
        self.b_told = np.array([f"{i}{c}" for i in range(len(self.b_bytes)) for c in ",;"], object)
        # The same vocabulary, ids as ranks, in the faster of the two libraries.
        ranks = {t: i for i, t in enumerate(self.a_bytes) if t}
        self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _piece(self, i: int) -> bytes:
        name = self.second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.second.is_byte(i) else name.replace("▁", " ").encode()

    def first_ids(self, text: str) -> list[int]:
        if len(text) >= WIDE_BLANK and _WIDE_BLANK.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both, or none where the ids of one do not give back a blank and the text."""
        if not text:
            return [], []
        whole = b" " + text.encode()
        a, b = self.first_ids(" " + text), self.second.encode(text)
        if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return [], []
        return a, b


@functools.lru_cache(maxsize=2)
def pair_of(first: str, second: str) -> Pair:
    """One pair for each Python worker."""
    return Pair(first, second)


@dataclass
class Aligned:
    """One document: ids of both tokenizers, and behind which tokens its groups end."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray

    def __post_init__(self) -> None:
        self.sizes_a, self.sizes_b = np.diff(self.ends_a, prepend=0), np.diff(self.ends_b, prepend=0)

    def told(self, pair: Pair) -> str:
        """The groups as text: ids of the first tokenizer, a bar, those of the second; groups apart by semicolons."""
        own = np.empty(len(self.a) + len(self.b), object)
        for ids, ends, before, words in (
            (self.a, self.ends_a, np.repeat(self.ends_b - self.sizes_b, self.sizes_a), pair.a_told),
            (self.b, self.ends_b, np.repeat(self.ends_a, self.sizes_b), pair.b_told),
        ):
            last = np.zeros(len(ids), np.int64)
            last[ends - 1] = 1
            own[np.arange(len(ids)) + before] = words[2 * ids + last]
        return "".join(own.tolist())[:-1]

    def n_links(self) -> int:
        return int((self.sizes_a * self.sizes_b).sum())

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the linked id pairs, in order, and how often each stands."""
        counts = self.sizes_a * self.sizes_b
        wide = np.flatnonzero(counts > WIDE_GROUP)
        counts[wide] = 0
        group = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
        row, column = np.divmod(place, self.sizes_b[group])
        first, second = (self.ends_a - self.sizes_a)[group], (self.ends_b - self.sizes_b)[group]
        codes, times = np.unique(self.a[first + row] * PAIR + self.b[second + column], return_counts=True)
        if not len(wide):
            return codes, times
        parts = [(codes, times)]
        for g in wide.tolist():
            own_a, own_b = self.a[: self.ends_a[g]][-self.sizes_a[g] :], self.b[: self.ends_b[g]][-self.sizes_b[g] :]
            (p, m), (q, n) = (np.unique(ids, return_counts=True) for ids in (own_a, own_b))
            parts.append((np.add.outer(p * PAIR, q).ravel(), np.multiply.outer(m, n).ravel()))
        codes, place = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
        times = np.zeros(len(codes), np.int64)
        np.add.at(times, place, np.concatenate([t for _, t in parts]))
        return codes, times


def align(pair: Pair, text: str | None) -> Aligned:
    """The tokens of a text and their groups; nothing where a tokenizer does not give back the text."""
    a, b = pair.tokens(text)
    ends = group_ends(
        list(accumulate(map(pair.a_sizes.__getitem__, a))), list(accumulate(map(pair.b_sizes.__getitem__, b)))
    )
    return Aligned(*[np.array(x, np.int64) for x in (a, b, *ends)])


def aligned(docs: DataFrame, first: str, second: str) -> DataFrame:
    """(doc_id, a_ids, b_ids, group_starts) of every row: the tokens of both and where groups start.

    group_starts holds the places (a, b) of the first tokens of each group in both lists.
    Texts, nulls and rows are treated as in ``link_counts``.
    """
    ship_code(docs.sparkSession)

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = pair_of(first, second)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = align(pair, text)
                starts = zip((own.ends_a - own.sizes_a).tolist(), (own.ends_b - own.sizes_b).tolist())
                rows.append((doc_id, own.a.tolist(), own.b.tolist(), [{"a": i, "b": j} for i, j in starts]))
            yield pd.DataFrame(rows, columns=["doc_id", "a_ids", "b_ids", "group_starts"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInPandas(
        made, "doc_id long, a_ids array<int>, b_ids array<int>, group_starts array<struct<a:int,b:int>>"
    )


_META = ["doc_ids", "n_a", "n_b", "n_groups", "n_links", "digests"]
_BLOCK = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>,"
    " digests array<string>, kinds binary, documents binary, sizes binary, steps binary, times binary"
)


def blocks(docs: DataFrame, first: str, second: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Stored blocks of aligned documents: their figures and the distinct pairs of each.

    kinds are the distinct pairs of the block in order and documents the number of its
    documents that hold each; of every document there stand the places of its pairs
    among them, as steps from the one before, and how often each is linked.
    """

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only_memory_of("alignment")
        pair = pair_of(first, second)
        number = TaskContext.get().partitionId() << 24
        rows, links, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = align(pair, text)
                told = hashlib.sha256(own.told(pair).encode()).hexdigest() if len(own.a) else ""
                links.append(own.links())
                id_or_none = None if pd.isna(doc_id) else int(doc_id)
                rows.append((id_or_none, len(own.a), len(own.b), len(own.ends_a), own.n_links(), told))
                held += len(links[-1][0]) + 50
                if held >= block_links:
                    yield _closed(number, rows, links)
                    rows, links, held, number = [], [], 0, number + 1
        if rows:
            yield _closed(number, rows, links)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with small_batches(docs.sparkSession, TEXT_ROWS):
        return stored(rows.mapInPandas(made, _BLOCK), "aligned")


def _closed(number: int, rows: list[tuple], links: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    codes = np.concatenate([c for c, _ in links])
    times = np.concatenate([t for _, t in links]).astype(np.uint32)
    sizes = np.array([len(c) for c, _ in links], np.int64)
    kinds = np.unique(codes)
    place = np.searchsorted(kinds, codes)
    # The places of a document ascend: the first of each is kept, the others as steps.
    steps = np.diff(place, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[first] = place[first]
    row = dict(zip(_META, map(list, zip(*rows))))
    return pd.DataFrame(
        [
            {
                "block": number,
                **row,
                "kinds": kinds.tobytes(),
                "documents": np.bincount(place, minlength=len(kinds)).astype(np.uint32).tobytes(),
                "sizes": sizes.astype(np.uint32).tobytes(),
                "steps": steps.astype(np.uint32).tobytes(),
                "times": times.tobytes(),
            }
        ]
    )


def _kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for block, kinds, documents in zip(batch["block"], batch["kinds"], batch["documents"]):
            pairs = np.frombuffer(kinds, np.int64)
            yield pd.DataFrame({"block": block, "pair": pairs, "n": np.frombuffer(documents, np.uint32).astype(np.int64)})


def pair_counts(kinds: DataFrame) -> DataFrame:
    """(pair, total, best): in how many documents a pair stands, and whether no pair of its first id has more."""
    totals = kinds.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = stored(totals.withColumn("a", F.shiftright("pair", 24)), "pair-totals")
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    return totals.join(most, "a").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def link_counts(docs: DataFrame, first: str, second: str, block_links: int = BLOCK_LINKS) -> DataFrame:
    """Figures of the aligned tokens of every row, with counts of linked pairs over all documents.

    Tokens of ``first`` (a byte-level vocabulary, for a blank and the text) and ``second``
    (a sentencepiece model, for the text) are cut into groups at the byte offsets where
    tokens of both end; two tokens of one group are linked.  Returns doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256: the count of an id pair is the
    number of documents that hold it linked, n_best the number of links whose count is the
    highest of their first id, count_sum the sum of counts over links.

    Documents are aligned in blocks; a block gives each of its pairs once, with the number
    of its documents, so a pair that stands in most documents is one row of each block.
    Texts that are null, empty, or not given back by the bytes of both tokenizers' tokens
    have no tokens: zeros and an empty digest.  Equal rows are documents of their own and
    so is one without an id.  Other columns are ignored; an empty table gives no rows.
    """
    ship_code(docs.sparkSession)
    cut = blocks(docs, first, second, block_links)
    kinds = cut.select("block", "kinds", "documents").mapInPandas(_kinds, "block long, pair long, n long")
    counts = stored(pair_counts(kinds), "pair-counts")
    answers = kinds.join(counts, "pair").select("block", "pair", "total", "best")

    def scored(block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        found = found.sort_values("pair")
        if len(found) * 8 != len(row["kinds"]):
            raise ValueError(f"block {row['block']}: {len(found)} answers for {len(row['kinds']) // 8} pairs")
        sizes = np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
        steps, times = (np.frombuffer(row[c], np.uint32).astype(np.int64) for c in ("steps", "times"))
        sums = np.cumsum(steps)
        ends = np.cumsum(sizes)
        before = np.concatenate([[0], sums])[ends - sizes]
        place = sums - np.repeat(before, sizes)
        document = np.repeat(np.arange(len(sizes)), sizes)
        out = pd.DataFrame({name: list(row[name]) for name in _META})
        out.columns = ["doc_id", *_META[1:-1], "groups_sha256"]
        for name, value in (("n_best", found["best"]), ("count_sum", found["total"])):
            sums_of = np.zeros(len(sizes), np.int64)
            np.add.at(sums_of, document, times * value.to_numpy().astype(np.int64)[place])
            out[name] = sums_of
        return out.astype({"doc_id": "Int64"})

    schema = (
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
        " groups_sha256 string"
    )
    return cut.drop("documents").groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(scored, schema)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return link_counts(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
