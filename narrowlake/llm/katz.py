"""Katz backoff scores of documents from Good-Turing discounted counts kept in partitioned tables."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow.dataset as arrow_data
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import crc_fold, file_system, remembers, ship_code, stored, table, task_count
from narrowlake.session import work_dir

FOLDS = 10
# Pairs seen less often are left to backing off; counts above MOST are not discounted.
LEAST_PAIR = 1
MOST = 5
# Tokens of one block of documents, and keys that one merging task holds, about.
BLOCK_TOKENS = 2_000_000
TASK_KEYS = 3_000_000
LEAST_TASKS = 24
# Words are told apart by 48 bits of a hash, pairs by 40 bits within one of many tables.
WORD_BYTES, PAIR_BYTES = 6, 5
REMEMBERED = 100_000
# The base score's share for unseen tokens, a fixed value.
ADDED = 0.1
_END = np.uint64(1)
_START = np.uint64(2)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = max(xxhash.xxh3_64_intdigest(word) >> 16, 3)
        return value


_WORDS = _Words()
remembers("katz", _WORDS.clear)


def token_keys(text: str | None) -> np.ndarray:
    """48-bit keys of the words of a whole text, A-Z lower-cased, and of its end."""
    words = (text or "").encode().lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    out[-1] = _END
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _short(keys: np.ndarray, width: int) -> bytes:
    """The lowest bytes of each key."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _long(packed: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(packed) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8")


@dataclass
class Block:
    """Some documents as places in a sorted list of word keys, and the distinct pairs in them.

    Pairs are numbered history * (words + 1) + word; the history of a first word is the
    start, numbered behind the words.  ``learned`` marks the tokens of training documents.
    """

    keys: np.ndarray
    stream: np.ndarray
    lengths: np.ndarray
    learned: np.ndarray = field(init=False)
    codes: np.ndarray = field(init=False)
    place: np.ndarray = field(init=False)
    starts: np.ndarray = field(init=False)

    def fill(self, held: np.ndarray) -> Block:
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.learned = np.repeat(~held, self.lengths)
        history = np.empty(len(self.stream), np.int64)
        history[1:] = self.stream[:-1]
        history[self.starts] = len(self.keys)
        self.codes, self.place = np.unique(
            history * (len(self.keys) + 1) + self.stream, return_inverse=True
        )
        return self

    def histories(self) -> np.ndarray:
        return self.codes // (len(self.keys) + 1)

    def words(self) -> np.ndarray:
        return self.codes % (len(self.keys) + 1)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.stream[self.learned], minlength=len(self.keys)).astype(np.uint32)

    def pair_counts(self) -> np.ndarray:
        return np.bincount(self.place[self.learned], minlength=len(self.codes)).astype(np.uint32)

    def pair_keys(self) -> np.ndarray:
        named = np.append(self.keys, _START)
        return _mixed(_mixed(named[self.histories()] + np.uint64(0x51)) + named[self.words()])


def blocks(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Stored blocks of documents: ids, folds, sizes, sorted word keys, tokens as places among them."""

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, held, parts, total, number = [], [], [], 0, 0
        first = TaskContext.get().partitionId() << 24

        def close() -> pd.DataFrame:
            keys, stream = np.unique(np.concatenate(parts), return_inverse=True)
            lengths = np.array([len(p) for p in parts], np.int64)
            row = {
                "block": first + number,
                "ids": np.array([0 if i is None else i for i in ids], np.int64).tobytes(),
                "nulls": np.array([i is None for i in ids], np.uint8).tobytes(),
                "held": np.array(held, np.uint8).tobytes(),
                "lengths": lengths.tobytes(),
                "keys": _short(keys, WORD_BYTES),
                "stream": stream.astype(np.uint32).tobytes(),
                "words": len(keys),
                "tokens": len(stream),
                "learned": int((~np.array(held, bool)).sum()),
            }
            return pd.DataFrame([row])

        for batch in batches:
            for doc_id, fold, text in zip(batch["doc_id"], batch["held"], batch["text"]):
                own = token_keys(text)
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                held.append(bool(fold))
                parts.append(own)
                total += len(own)
                if total >= block_tokens:
                    yield close()
                    ids, held, parts, total, number = [], [], [], 0, number + 1
        if parts:
            yield close()

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (crc_fold(F.col("doc_id"), FOLDS) == 0).alias("held"),
        "text",
    )
    schema = (
        "block long, ids binary, nulls binary, held binary, lengths binary, keys binary, stream binary,"
        " words long, tokens long, learned long"
    )
    return stored(rows.mapInPandas(made, schema), "blocks")


def _block(row) -> Block:
    block = Block(
        _long(row.keys, WORD_BYTES), np.frombuffer(row.stream, np.uint32).astype(np.int64), np.frombuffer(row.lengths, np.int64)
    )
    return block.fill(np.frombuffer(row.held, np.uint8).astype(bool))


def _sent(block: int, keys: np.ndarray, tables: int, width: int, **columns: np.ndarray) -> pd.DataFrame:
    """One row for each table that holds some of the sorted keys of a block; tables are ranges of keys."""
    bits = np.uint64(64) if width == PAIR_BYTES else np.uint64(8 * WORD_BYTES)
    bounds = np.array([i * 2 ** int(bits) // tables for i in range(tables)], np.uint64)
    cuts = np.append(np.searchsorted(keys, bounds), len(keys))
    rows = []
    for t in range(tables):
        part = slice(cuts[t], cuts[t + 1])
        if cuts[t] < cuts[t + 1]:
            rows.append((t, block, _short(keys[part], width), *[c[part].tobytes() for c in columns.values()]))
    return pd.DataFrame(rows, columns=["table", "block", "keys", *columns])


def _counted(sent: DataFrame, width: int) -> DataFrame:
    """Merge counts by key in each table; returns to each block the totals in its own order.

    A total is doubled and its lowest bit marks the block that answers for the key.  A row
    without a block sums up the table: tokens, kinds, and kinds seen 1, 2, ... times.
    """

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(k) // width for k in rows["keys"]]
        keys = _long(b"".join(rows["keys"]), width)
        counts = np.frombuffer(b"".join(rows["counts"]), np.uint32)
        kinds, place = np.unique(keys, return_inverse=True)
        totals = np.bincount(place, weights=counts, minlength=len(kinds)).astype(np.uint64)
        seen = np.flatnonzero(counts)
        owner = np.zeros(len(keys), np.uint64)
        owner[seen[np.unique(place[seen], return_index=True)[1]]] = 1
        marked = totals[place] * np.uint64(2) + owner
        kind = np.uint32 if marked.max(initial=0) < 2**32 else np.uint64
        ends = np.cumsum(sizes)
        out = pd.DataFrame(
            {
                "block": rows["block"],
                "table": rows["table"],
                "marked": [marked[e - s : e].astype(kind).tobytes() for s, e in zip(sizes, ends)],
                "width": np.dtype(kind).itemsize,
            }
        )
        seen_times = np.bincount(np.minimum(totals, MOST + 2).astype(np.int64), minlength=MOST + 3)
        stats = [int(totals.sum()), int((totals > 0).sum()), *map(int, seen_times[1 : MOST + 2])]
        return pd.concat([out.assign(stats=None), pd.DataFrame([{"block": None, "stats": stats}])]).astype(
            {"block": "Int64", "table": "Int32", "width": "Int32"}
        )

    schema = "block long, table int, marked binary, width int, stats array<long>"
    return sent.groupBy("table").applyInPandas(merge, schema)


def _answers(merged: DataFrame, folder: str, columns: list[str]) -> None:
    """Write each block's answers to a folder of its own, one file each."""
    rows = merged.where("block IS NOT NULL").select("block", "table", *columns)
    rows = rows.repartition("block").sortWithinPartitions("block", "table")
    rows.write.option("compression", "zstd").partitionBy("block").parquet(folder)


def _answer(folder: str, block: int) -> pd.DataFrame:
    store, place = file_system(posixpath.join(folder, f"block={block}"))
    found = arrow_data.dataset(place, filesystem=store, format="parquet", partitioning=None)
    return found.to_table().to_pandas().sort_values("table")


def _marked(folder: str, block: int, rows: int) -> np.ndarray:
    parts = [np.frombuffer(m, f"<u{w}").astype(np.uint64) for m, w in zip(*_columns(folder, block, ["marked", "width"]))]
    out = np.concatenate([np.empty(0, np.uint64), *parts])
    if len(out) != rows:
        raise ValueError(f"block {block}: {len(out)} answers for {rows} keys")
    return out


def _columns(folder: str, block: int, names: list[str]) -> list:
    found = _answer(folder, block)
    return [found[n] for n in names]


def _stats(merged: DataFrame) -> list[int]:
    rows = merged.where("block IS NULL")
    sums = rows.agg(*[F.sum(F.get("stats", F.lit(i))) for i in range(MOST + 3)]).first()
    return [int(x or 0) for x in sums]


def discounts(kinds: list[int]) -> np.ndarray:
    """Katz's factors for counts 0 to MOST from the numbers of kinds seen 1, 2, ... MOST + 1 times.

    Good-Turing estimates are rescaled so that counts above MOST keep theirs; where the
    numbers give no factor between 0 and 1, half a count is taken off.
    """
    out = np.ones(MOST + 1)
    beyond = (MOST + 1) * kinds[MOST] / kinds[0] if kinds[0] else 1.0
    for r in range(1, MOST + 1):
        ratio = (r + 1) * kinds[r] / (r * kinds[r - 1]) if kinds[r - 1] else 0.0
        factor = (ratio - beyond) / (1 - beyond) if beyond < 1 else 0.0
        out[r] = factor if 0 < factor < 1 else (r - 0.5) / r
    return out


@dataclass(frozen=True)
class Model:
    """Totals and factors; the tables of counts and backoff sums stay in their folders."""

    tokens: int
    kinds: int
    documents: int
    word_factors: np.ndarray
    pair_factors: np.ndarray
    left: float  # mass of all unseen words together
    shrink: float  # below 1 only where discounts leave no mass

    def word_chance(self, counts: np.ndarray) -> np.ndarray:
        if not self.tokens:
            return np.ones(len(counts))
        kept = _factor(self.word_factors, counts) * counts / self.tokens * self.shrink
        return np.where(counts > 0, kept, self.left)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.kinds + 1)))


def _factor(factors: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.where(counts <= MOST, factors[np.minimum(counts, MOST).astype(np.int64)], 1.0)


def _model(words: list[int], pairs: list[int], documents: int) -> Model:
    tokens, kinds, *seen = words
    factors = discounts(seen)
    lost = sum((1 - factors[r]) * r * seen[r - 1] for r in range(1, MOST + 1))
    left = lost / tokens if tokens else 1.0
    shrink = 1.0
    if tokens and left < 1e-12:
        left, shrink = 1 / (tokens + 1), tokens / (tokens + 1)
    return Model(tokens, kinds, documents, factors, discounts(pairs[2:]), left, shrink)


def _history_counts(model: Model, words: np.ndarray) -> np.ndarray:
    """Training counts of each word of a block as a history, and of the start."""
    return np.append(words, np.uint64(model.documents)).astype(np.float64)


def scores(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Documents are cut into blocks and learned from outside the held-out fold.  Each block
    sends its distinct words and pairs with counts to tables dealt by key; the tables return
    the totals, so a hot word is one key of each block and no key grows with its
    frequency.  Pairs seen LEAST_PAIR times or more are discounted by Good-Turing; for each
    history the mass left over and the words' own chances among its pairs are summed over
    all blocks, which normalises the backoff weight exactly:

        p(w | h) = d(c) c / c(h)                      where the pair is kept
                 = p(w) (1 - sum d c / c(h)) / (1 - sum p)   otherwise
        p(w)     = d(c) c / N, or all mass left over for the unseen word

    A block's answers are one folder of each table; a task reads those of its own blocks and
    scores every token of whole texts.  A null text is its end alone.  A null doc_id counts
    as an empty text for the fold.  Equal rows are learned and scored each.  Without
    training documents every chance of the model is 1 and base scores have N = V = 0.
    """
    ship_code(docs.sparkSession)
    cut = blocks(docs, block_tokens)
    totals = cut.agg(F.sum("words"), F.sum("tokens"), F.sum("learned")).first()
    words, tokens, learned = (int(x or 0) for x in totals)
    word_tables = task_count(words, TASK_KEYS, LEAST_TASKS)
    pair_tables = task_count(tokens, TASK_KEYS, LEAST_TASKS)
    spark = docs.sparkSession
    word_folder, pair_folder, back_folder = (work_dir(spark, n) for n in ("words", "pairs", "backoff"))

    def send_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                keys = _long(row.keys, WORD_BYTES)
                stream = np.frombuffer(row.stream, np.uint32)
                learned = np.repeat(np.frombuffer(row.held, np.uint8) == 0, np.frombuffer(row.lengths, np.int64))
                counts = np.bincount(stream[learned], minlength=len(keys)).astype(np.uint32)
                yield _sent(row.block, keys, word_tables, WORD_BYTES, counts=counts)

    def send_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block = _block(row)
                keys = block.pair_keys()
                order = np.argsort(keys)
                yield _sent(row.block, keys[order], pair_tables, PAIR_BYTES, counts=block.pair_counts()[order])

    sent = "table int, block long, keys binary, counts binary"
    need = cut.select("block", "held", "lengths", "keys", "stream")
    word_rows = stored(_counted(need.mapInPandas(send_words, sent), WORD_BYTES), "word-counts")
    _answers(word_rows, word_folder, ["marked", "width"])
    pair_rows = stored(_counted(need.mapInPandas(send_pairs, sent), PAIR_BYTES), "pair-counts")
    _answers(pair_rows, pair_folder, ["marked", "width"])
    model = _model(_stats(word_rows), _stats(pair_rows), learned)

    def known(row) -> tuple[Block, np.ndarray, np.ndarray, np.ndarray]:
        """A block with the totals of its words and pairs, and the pairs it answers for."""
        block = _block(row)
        words = _marked(word_folder, row.block, len(block.keys)) >> np.uint64(1)
        marked = np.empty(len(block.codes), np.uint64)
        marked[np.argsort(block.pair_keys())] = _marked(pair_folder, row.block, len(block.codes))
        return block, words, marked >> np.uint64(1), (marked & np.uint64(1)).astype(bool)

    def send_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block, words, pairs, owned = known(row)
                own = np.flatnonzero(owned & (pairs >= LEAST_PAIR))
                history, count = block.histories()[own], pairs[own].astype(np.float64)
                size = len(block.keys) + 1
                mass = np.bincount(history, _factor(model.pair_factors, pairs[own]) * count, size)
                chance = np.bincount(history, model.word_chance(words[block.words()[own]]), size)
                # The start comes last; its key is below all others, so it goes first.
                keys = np.concatenate([[_START], block.keys])
                mass, chance = np.roll(mass, 1), np.roll(chance, 1)
                asks = np.concatenate([[True], words >= LEAST_PAIR])
                order = np.argsort(keys[asks], kind="stable")
                yield _sent(
                    row.block, keys[asks][order], word_tables, WORD_BYTES, mass=mass[asks][order], chance=chance[asks][order]
                )

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(k) // WORD_BYTES for k in rows["keys"]]
        _, place = np.unique(_long(b"".join(rows["keys"]), WORD_BYTES), return_inverse=True)
        out = {"block": rows["block"], "table": rows["table"]}
        for name in ("mass", "chance"):
            sums = np.bincount(place, np.frombuffer(b"".join(rows[name]), np.float64))[place]
            out[name] = [part.tobytes() for part in np.split(sums, np.cumsum(sizes)[:-1])]
        return pd.DataFrame(out)

    sums = need.mapInPandas(send_sums, "table int, block long, keys binary, mass binary, chance binary")
    sums = sums.groupBy("table").applyInPandas(add, "block long, table int, mass binary, chance binary")
    _answers(sums, back_folder, ["mass", "chance"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                block, words, pairs, _ = known(row)
                mass, chance = (
                    np.frombuffer(b"".join(c), np.float64) for c in _columns(back_folder, row.block, ["mass", "chance"])
                )
                asks = np.flatnonzero(np.concatenate([[True], words >= LEAST_PAIR]))
                asks = asks[np.argsort(np.concatenate([[_START], block.keys])[asks], kind="stable")]
                used, seen = np.zeros(len(words) + 1), np.zeros(len(words) + 1)
                used[asks], seen[asks] = mass, chance
                token = pair_scores(
                    model,
                    _history_counts(model, words)[block.histories()],
                    np.roll(used, -1)[block.histories()],
                    np.roll(seen, -1)[block.histories()],
                    words[block.words()],
                    pairs,
                )
                base = model.base(words.astype(np.float64))
                nulls = np.frombuffer(row.nulls, np.uint8).astype(bool)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(np.frombuffer(row.ids, np.int64), dtype="Int64").copy(),
                        "held_out": np.frombuffer(row.held, np.uint8).astype(bool),
                        "n_tokens": block.lengths,
                        "n_known": np.add.reduceat((words[block.stream] > 0).astype(np.int64), block.starts),
                        "train_tokens": model.tokens,
                        "base_score": np.add.reduceat(base[block.stream], block.starts),
                        "score": np.add.reduceat(token[block.place], block.starts),
                    }
                ).assign(doc_id=lambda d: d["doc_id"].mask(nulls))

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double"
    )
    return cut.mapInPandas(score, schema)


def pair_scores(model, history, mass, chance, words, pairs) -> np.ndarray:
    """log10 p(w | h) of pairs, from the counts of history, word and pair and the history's sums."""
    own = model.word_chance(words)
    # A history whose pairs keep all of its mass gives up the share of one more token.
    total = np.where(history - mass < 1e-9, history + 1, history)
    with np.errstate(divide="ignore", invalid="ignore"):
        kept = _factor(model.pair_factors, pairs) * pairs / total
        back = (1 - mass / total) / (1 - chance) * own
    seen = history > 0
    return np.log10(np.where(seen & (pairs >= LEAST_PAIR), kept, np.where(seen, back, own)))


def op3_katz(spark: SparkSession, folder: str) -> DataFrame:
    return scores(table(spark, folder, "documents").select("doc_id", "text"))
