"""Aligned tokens against the libraries themselves and a plain walk over all byte offsets."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from narrowlake.llm import alignment

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 256
    for b in range(256):
        if b in plain:
            out[chr(b)] = b
        else:
            out[chr(extra)] = b
            extra += 1
    return out


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=SECOND), plain_letters()


def plain_tokens(libraries, text):
    """(id, bytes) of both libraries, or None."""
    first, second, letters = libraries
    if not text:
        return None
    a = first.encode(" " + text, add_special_tokens=False).ids
    a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in a]
    b = []
    for i in second.encode(text):
        name = second.id_to_piece(i)
        b.append((i, bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()))
    whole = b" " + text.encode()
    return (a, b) if all(b"".join(t for _, t in own) == whole for own in (a, b)) else None


def plain_groups(tokens):
    a, b = tokens
    ends = []
    for own in tokens:
        at, out = 0, []
        for _, t in own:
            at += len(t)
            out.append(at)
        ends.append(out)
    both, sides = set(ends[0]) & set(ends[1]), []
    for own, es in zip(tokens, ends):
        side, group = [], []
        for (i, _), e in zip(own, es):
            group.append(i)
            if e in both:
                side.append(tuple(group))
                group = []
        sides.append(side)
    return list(zip(*sides))


def plain_rows(libraries, texts):
    found, counts = [], collections.Counter()
    for doc_id, text in texts:
        tokens = plain_tokens(libraries, text)
        groups = plain_groups(tokens) if tokens else []
        links = [(p, q) for left, right in groups for p in left for q in right]
        counts.update(set(links))
        found.append((doc_id, tokens, groups, links))
    best = collections.Counter()
    for (p, _), n in counts.items():
        best[p] = max(best[p], n)
    rows = []
    for doc_id, tokens, groups, links in found:
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(told.encode()).hexdigest() if tokens else ""
        sizes = [len(own) for own in tokens] if tokens else [0, 0]
        sums = [sum(counts[k] == best[k[0]] for k in links), sum(counts[k] for k in links)]
        rows.append((doc_id, *sizes, len(groups), len(links), *sums, digest))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_groups_equal_a_plain_walk(seed):
    draw = random.Random(seed)
    for _ in range(300):
        size = draw.randint(1, 200)
        ends = [sorted({*draw.sample(range(1, size + 1), draw.randint(0, size)), size}) for _ in range(2)]
        if draw.random() < 0.5:
            ends[1] = sorted({*ends[0], *draw.sample(range(1, size + 1), min(size, 3))})
        cuts = sorted(set(ends[0]) & set(ends[1]))
        for own, found in zip(ends, alignment.group_ends(*ends)):
            assert [own[i - 1] for i in found] == cuts


@pytest.mark.parametrize(
    "text",
    [
        "a", " ", "  two  blanks ", "tab\tand\nline\r\n", "<s> </s> <|endoftext|> <unk> <0x41>", "▁ low line", "a▁b",
        "naïve café ﬁ Ⅱ é İstanbul ΣΑΣ", "日本語のテキスト と 한국어", "emoji 😀😀 👩‍👩‍👧", "x\x00y\x1cz", "don't we'll I'M", "a" * 3_000,
        " " * 20_000 + "x" + "\n" * 9_000, " " * 50 + "x" + " " * 51, "﻿mark", "1234567890 3.14 10,000",
    ],
)
def test_tokens_equal_the_libraries(libraries, text):
    pair = alignment.pair_of(FIRST, SECOND)
    want = plain_tokens(libraries, text) or ([], [])
    assert pair.tokens(text) == tuple([i for i, _ in own] for own in want)
    own = alignment.align(pair, text)
    told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in plain_groups(want) if want[0])
    assert own.told(pair) == told


def test_wide_groups_are_counted_by_distinct_ids(monkeypatch):
    draw = random.Random(3)
    ids = [[draw.randrange(9) for _ in range(n)] for n in (40, 30)]
    own = alignment.Aligned(*[np.array(x) for x in (*ids, [40], [30])])
    plain = [own.links()]
    monkeypatch.setattr(alignment, "WIDE_GROUP", 5)
    plain.append(own.links())
    sums = [collections.Counter() for _ in plain]
    for found, (codes, times) in zip(sums, plain):
        for c, t in zip(codes.tolist(), times.tolist()):
            found[c] += t
    assert sums[0] == sums[1] and sum(sums[0].values()) == 1_200


def test_the_query_equals_a_plain_count(spark, libraries, docs, texts):
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    wanted = sorted(plain_rows(libraries, texts), key=key)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for block_links in (3_000, alignment.BLOCK_LINKS):
        found = alignment.link_counts(docs, FIRST, SECOND, block_links)
        assert sorted((tuple(r) for r in found.select(*names).collect()), key=key) == wanted
    assert sum(r[5] for r in wanted) < sum(r[4] for r in wanted)


def test_whole_outputs_and_empty_tables(spark, libraries, docs, no_docs):
    few = docs.where("doc_id % 20 = 0 AND length(text) < 5000 OR doc_id IS NULL")
    for row in alignment.aligned(few, FIRST, SECOND).collect():
        text = few.where(F.col("doc_id").eqNullSafe(row["doc_id"])).first()["text"] if row["doc_id"] is not None else None
        if text is None:
            continue
        tokens = plain_tokens(libraries, text)
        assert [row["a_ids"], row["b_ids"]] == [[i for i, _ in own] for own in tokens or ([], [])]
        assert len(row["group_starts"]) == (len(plain_groups(tokens)) if tokens else 0)
    assert alignment.aligned(no_docs, FIRST, SECOND).isEmpty()
    assert alignment.link_counts(no_docs, FIRST, SECOND).isEmpty()
