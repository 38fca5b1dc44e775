"""Runs of repeated word patterns: recursive frequency splitting, then a lag scan of what is left."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import crc_fold, ship_code, table

# A run has so many words at least, and two periods.
LEAST = 12
# Pairs of places that are extended together.
PAIRS = 100_000
# Times that all segments of a text are split together, before each is split by itself.
ROUNDS = 6
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def segments(codes: np.ndarray, least: int = LEAST) -> Iterator[tuple[int, int]]:
    """Stretches (first, behind the last) that can hold runs: every word stands in them twice.

    A word of a run stands in it twice at least, so a word that occurs once within its
    segment splits it, and so do the parts until none holds such a word.  All segments are
    split at once in the first rounds, which is enough for ordinary texts; what is not
    stable then is split one by one.
    """
    places = np.arange(len(codes) if len(codes) >= least else 0)
    stable = False
    for _ in range(ROUNDS):
        if stable or not len(places):
            break
        name = (np.cumsum(np.diff(places, prepend=places[0]) > 1) << 32) + codes[places]
        _, name, count = np.unique(name, return_inverse=True, return_counts=True)
        often = count[name] > 1
        stable = often.all()
        places = places[often]
        sizes = np.diff(np.append(_starts(places), len(places)))
        places = places[np.repeat(sizes >= least, sizes)]
    starts = _starts(places)
    for low, size in zip(places[starts].tolist(), np.diff(np.append(starts, len(places))).tolist()):
        if stable:
            yield low, low + size
        else:
            yield from _splits(codes[low : low + size].tolist(), low, least)


def _starts(places: np.ndarray) -> np.ndarray:
    """Where stretches of neighbouring places begin."""
    return np.flatnonzero(np.diff(places, prepend=-2) != 1)


def _splits(codes: list[int], offset: int, least: int) -> Iterator[tuple[int, int]]:
    """The same, a cut at a time: rare words are looked for from both ends and only the shorter
    part is counted anew, so the work is at most the number of words times its logarithm."""
    todo = [(0, len(codes), Counter(codes))]
    while todo:
        low, high, count = todo.pop()
        if high - low < least:
            continue
        cut = None
        for near in range((high - low + 1) // 2):
            if count[codes[low + near]] < 2:
                cut = low + near
                break
            if count[codes[high - 1 - near]] < 2:
                cut = high - 1 - near
                break
        if cut is None:
            yield offset + low, offset + high
            continue
        parts = (low, cut), (cut + 1, high)
        small, large = sorted(parts, key=lambda p: p[1] - p[0])
        own = Counter(codes[small[0] : small[1]])
        count.subtract(own)
        count[codes[cut]] -= 1
        todo += [(*small, own), (*large, count)]


class _Blocks:
    """Numbers of all stretches of 1, 2, 4, ... words, equal for equal stretches."""

    def __init__(self, words: np.ndarray):
        self.size = len(words)
        self.names = [np.unique(words, return_inverse=True)[1].astype(np.int32)]
        width = 1
        while 2 * width <= self.size:
            half = self.names[-1].astype(np.int64)
            pairs = half[:-width] * (int(half.max()) + 1) + half[width:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
            width *= 2

    def after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from places a and b (a < b) on are equal."""
        equal = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.names))):
            fits = np.flatnonzero(b + equal + (1 << k) <= self.size)
            same = self.names[k][a[fits] + equal[fits]] == self.names[k][b[fits] + equal[fits]]
            equal[fits[same]] += 1 << k
        return equal

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before places a and b (a < b) are equal."""
        equal = np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.names))):
            fits = np.flatnonzero(a - equal >= 1 << k)
            back = equal[fits] + (1 << k)
            same = self.names[k][a[fits] - back] == self.names[k][b[fits] - back]
            equal[fits[same]] += 1 << k
        return equal


def lag_scan(words: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of the runs of one segment.

    At a lag q, the equal pairs of a run stretch over q places or more, so one of the
    places 0, q, 2q, ... is among them: only those are compared, and extended to both
    sides where they are equal.  Of runs at one place the smallest lag is the period.
    """
    blocks = _Blocks(words)
    found, waiting, held = [np.empty((0, 3), np.int64)], [], 0

    def extend() -> None:
        at, lag = np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])
        back = blocks.before(at, at + lag)
        equal = blocks.after(at, at + lag) + back
        keep = (equal >= lag) & (equal + lag >= least)
        rows = np.stack([at - back, equal + lag, lag], 1)[keep]
        found.append(np.unique(rows, axis=0))

    for lag in range(1, len(words) // 2 + 1):
        hit = np.flatnonzero(words[:-lag:lag] == words[lag::lag][: len(words[:-lag:lag])]) * lag
        if len(hit):
            waiting.append((hit, np.full(len(hit), lag)))
            held += len(hit)
        if held >= PAIRS:
            extend()
            waiting, held = [], 0
    if waiting:
        extend()
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    same = np.zeros(len(runs), bool)
    same[1:] = (runs[1:, :2] == runs[:-1, :2]).all(1)
    return runs[~same]


def runs_of(words: list[bytes], least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of a text's words, by start and period."""
    number: dict[bytes, int] = {}
    codes = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    found = [np.empty((0, 3), np.int64)]
    for low, high in segments(codes, least):
        part = lag_scan(codes[low:high], least)
        part[:, 0] += low
        found.append(part)
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """The words that no run holds behind its first period, joined by one blank."""
    if not len(runs):
        return b" ".join(words).decode()
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()
    return b" ".join([words[i] for i in kept]).decode()


def periodic_runs(docs: DataFrame, text: Column | str = "text", least: int = LEAST) -> DataFrame:
    """The documents with ``word_runs`` and ``collapsed_text``.

    A run is a stretch of consecutive words with smallest period q, that is, words q apart
    are identical, of ``least`` words and two periods or more, that no neighbouring word
    extends.  word_runs holds (start, length, period) of all runs of a whole text, places
    counted in words from 0, by start and period; collapsed_text the words that no run
    holds behind its first period.

    Words end at ASCII white space and compare by their bytes.  Null, empty and blank texts
    have no runs and an empty collapsed text.  Texts are looked at one by one, in time that
    grows like their length times the square of its logarithm, so one of a million equal words
    or equal rows cost no more than others; an empty table gives an empty result.  Existing
    columns of the two names are replaced, others stay.
    """
    ship_code(docs.sparkSession)

    @F.pandas_udf(f"runs {RUNS}, kept string")
    def scanned(texts: pd.Series) -> pd.DataFrame:
        runs, kept = [], []
        for content in texts:
            words = (content or "").encode().split()
            found = runs_of(words, least)
            runs.append([dict(zip(("start", "length", "period"), row)) for row in found.tolist()])
            kept.append(collapsed(words, found))
        return pd.DataFrame({"runs": runs, "kept": kept})

    taken = F.col(text) if isinstance(text, str) else text
    made = docs.withColumn("_scanned", scanned(taken))
    return made.withColumns(
        {"word_runs": F.col("_scanned.runs"), "collapsed_text": F.col("_scanned.kept")}
    ).drop("_scanned")


def planted(doc_id: Column, text: Column) -> Column:
    """The text, made periodic from some word on in a tenth of the documents, by a hash of the id.

    A null id leaves the text as it is.
    """

    @F.pandas_udf("string")
    def repeated(hashes: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for h, content in zip(hashes, texts):
            if not pd.isna(h) and h % 10 == 0:
                words = (content or "").encode().split()
                n, g = len(words), int(h) // 10
                if n:
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    words[a:] = [words[a + i % p] for i in range(n - a)]
                    content = b" ".join(words).decode()
            out.append(content)
        return pd.Series(out, dtype=object)

    return repeated(F.when(doc_id.isNotNull(), crc_fold(doc_id, 1 << 32)), text)


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run and digests of runs and collapsed text."""
    runs = F.col("word_runs")
    longest = F.array_max(
        F.transform(
            runs,
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    lines = F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = longest["length"], -longest["period"]
    # Whole numbers throughout: no rounding.
    exponent = (1000 * length - F.pmod(1000 * length, period)) / period
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        (-longest["start"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        exponent.cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digests(periodic_runs(docs, planted(F.col("doc_id"), F.col("text"))))
