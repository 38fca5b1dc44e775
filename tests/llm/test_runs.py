"""Periodic runs against a plain search over all periods and places."""

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from narrowlake.llm import periodic_runs


def plain_runs(words, least=12):
    """Maximal stretches of each period, smallest period first at any place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(least, 2 * q):
                found.setdefault((at, length), q)
            at = end + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in gone]


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = (zlib.crc32(str(doc_id).encode()), len(words)) if doc_id is not None else (1, 0)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = b" ".join(plain_collapsed(words, runs))
    longest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_a_plain_search(seed):
    draw = random.Random(seed)
    for _ in range(150):
        kinds, size = draw.randint(1, 6), draw.randint(0, 120)
        words = [str(draw.randrange(kinds)).encode() for _ in range(size)]
        for _ in range(draw.randint(0, 3)):
            q = draw.randint(1, 20)
            words[draw.randint(0, len(words)) :] = words[:q] * draw.randint(0, 4)
        got = [tuple(r) for r in periodic_runs.runs_of(words).tolist()]
        assert got == plain_runs(words)
        assert periodic_runs.collapsed(words, periodic_runs.runs_of(words)).encode().split() == plain_collapsed(words, got)


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_segments_are_stable_and_hold_all_runs(monkeypatch, rounds):
    monkeypatch.setattr(periodic_runs, "ROUNDS", rounds)
    draw = random.Random(1)
    for _ in range(200):
        codes = [draw.randrange(12) for _ in range(draw.randint(0, 60))]
        parts = list(periodic_runs.segments(np.array(codes)))
        for low, high in parts:
            inside = codes[low:high]
            assert high - low >= 12 and all(inside.count(c) > 1 for c in inside)
        for s, n, _ in plain_runs(codes):
            assert any(low <= s and s + n <= high for low, high in parts)


@pytest.mark.parametrize(
    "words",
    [
        [b"a"] * 200_000,
        [b"a", b"b", b"c"] * 70_000,
        [str(i % 60_000).encode() for i in range(200_000)],
        # Each cut makes one more word rare.
        [str(i // 2 + (i % 2) * 2).encode() for i in range(200_000)],
    ],
)
def test_texts_of_a_megabyte_take_seconds(words):
    start = time.time()
    runs = periodic_runs.runs_of(words)
    assert time.time() - start < 30
    assert len(runs) <= 1


def test_the_query_equals_a_plain_search(spark, docs, texts):
    found = periodic_runs.digests(
        periodic_runs.periodic_runs(docs, periodic_runs.planted(F.col("doc_id"), F.col("text")))
    )
    key = lambda r: (r[0] is None, r[0] or 0, r[-1])
    short = [(i, t) for i, t in texts if len(t or "") < 8_000]
    wanted = sorted((plain_row(i, t) for i, t in short), key=key)
    got = sorted((tuple(r) for r in found.collect()), key=key)
    long = {i for i, t in texts if len(t or "") >= 8_000}
    assert [r for r in got if r[0] not in long] == wanted
    assert any(r[1] for r in wanted)


def test_columns_and_empty_tables(spark, docs, no_docs):
    clashing = docs.withColumns({"word_runs": F.lit(1), "runs": F.lit(2), "collapsed_text": F.lit(3)})
    found = periodic_runs.periodic_runs(clashing)
    assert found.count() == docs.count()
    assert set(found.columns) == {*docs.columns, "word_runs", "runs", "collapsed_text"}
    assert found.where("runs != 2").isEmpty()
    assert periodic_runs.digests(periodic_runs.periodic_runs(no_docs)).isEmpty()
