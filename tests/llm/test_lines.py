"""Line dedup against a plain count of keys."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from narrowlake.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"


def plain_key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def plain_rows(texts):
    held = collections.defaultdict(set)
    for doc_id, text in texts:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                held[plain_key(line)].add(doc_id)
    rows = []
    for doc_id, text in texts:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if doc_id is None
            or len(plain_key(line)) < 10
            or len(held[plain_key(line)]) < 2
            or min(held[plain_key(line)]) == doc_id
        ]
        rows.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(rows, key=str)


LINES = [
    (1, "a line that is long\nA LINE that is long  \nother"),
    (2, "\ta line that is long\nshort\nshort\nunlike any other"),
    (2, "a line that is long"),
    (3, "A line that is long\r\néééééééééé"),
    (4, "éééééééééé\nééééééééé\nnine char\nten chars!"),
    (5, "nine char\nten chars!\nééééééééé\n ten chars!"),
    (6, "\n\n   \n"),
    (7, "İstanbul is a town\n\x1ca line that is long"),
    (8, "i̇stanbul is a town\n\x1ca line that is long"),
    (None, "a line that is long"),
    (None, "only rows without an id\nhave this"),
    (9, "only rows without an id\nhave this"),
    (10, ""),
    (11, None),
    (12, "some line of this very long text\n" * 50_000 + "a line that is long"),
]


@pytest.mark.parametrize("block_lines", [3, 1_000, line_dedup.BLOCK_LINES])
def test_equals_a_plain_count(spark, docs, texts, block_lines):
    more = spark.createDataFrame(LINES, "doc_id long, text string")
    rows = docs.unionByName(more, allowMissingColumns=True) if block_lines > 3 else more
    found = line_dedup.without_repeated_lines(rows, block_lines)
    got = [tuple(r) for r in found.select("doc_id", "line_count", "lines_dropped", "kept_text").collect()]
    assert sorted(got, key=str) == plain_rows([*(texts if block_lines > 3 else []), *LINES])
    assert set(found.columns) == {*rows.columns, "line_count", "lines_dropped", "kept_text"}


def test_filters_deny_no_repeated_hash():
    draw = np.random.default_rng(1)
    hashes = draw.integers(0, 2**63, 50_000, dtype=np.uint64)
    rows = []
    for block in range(8):
        own = np.unique(draw.choice(hashes, 4_000))
        rows.append((0, block, own[:-5].tobytes(), own[-5:].tobytes()))
    import pandas as pd

    rows = pd.DataFrame(rows, columns=["part", "block", "single", "repeated"])
    seen = collections.Counter()
    for single, repeated in zip(rows["single"], rows["repeated"]):
        seen.update(np.frombuffer(single, np.uint64).tolist())
        seen.update(np.frombuffer(repeated, np.uint64).tolist() * 2)
    asked = set()
    for hashes in line_dedup.suspects(rows)["hashes"]:
        asked |= set(np.frombuffer(hashes, np.uint64).tolist())
    often = {h for h, n in seen.items() if n > 1}
    assert often <= asked
    assert len(asked - often) < 0.05 * len(seen)


def test_clashing_columns_and_empty_tables(spark, docs, no_docs):
    clashing = docs.withColumns({"line_count": F.lit(1), "gone": F.lit(2), "digest": F.lit(3), "first": F.lit(4)})
    found = line_dedup.without_repeated_lines(clashing)
    assert found.count() == docs.count()
    assert found.where("gone != 2 OR digest != 3 OR first != 4").isEmpty()
    assert line_dedup.without_repeated_lines(no_docs).isEmpty()
