"""Word n-gram Jaccard join by parity sketches: XOR-hashed segments, pigeonhole, exact check."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from narrowlake.llm.common import (
    only_memory_of,
    remembers,
    scratch,
    ship_code,
    small_batches,
    stored,
    table,
    task_count,
)
from narrowlake.llm.components import components

# Words whose hashes one Python worker remembers.
REMEMBERED = 100_000
# Sets that one task remembers to have emitted; copies beyond it are emitted again, no more.
SEEN = 200_000
# Keys that are sent together, and those that one table holds, about.
PACK_KEYS = 600_000
TABLE_KEYS = 1_200_000
LEAST_TABLES = 24
# Texts, and sets, that a task hands to Python at a time.
TEXT_ROWS = 2_000
SET_ROWS = 500
# Bits of the sketch by which two sets are compared before their elements are.
SKETCH_BITS = 512
# Larger sets have a second one of a bit per element at least, up to this many (128 KB).
MOST_BITS = 2**20
# Members of one bucket compared in one place, and rows of many buckets in one call.
BUCKET_ROWS = 1_024
CALL_ROWS = 50_000
# Ids up to this many (32 MB) are sent to all tasks; beyond it the join shuffles texts.
MOST_SENT = 4_000_000
# Pairs of ids up to this many (16 MB) are sent to all tasks.
MOST_PAIRS_SENT = 1_000_000


@dataclass(frozen=True)
class Rule:
    """Sets of ``words``-word shingles are linked when upper * intersection >= lower * union."""

    words: int = 5
    lower: int = 8
    upper: int = 10

    @property
    def first(self) -> int:
        """The smallest set that can be linked with a different one."""
        return -(-self.lower // (self.upper - self.lower))

    def apart(self, sizes):
        """Most elements in which two linked sets of these sizes together differ."""
        return sizes * (self.upper - self.lower) // (self.upper + self.lower)

    def linked(self, common: int, a: int, b: int) -> bool:
        return self.upper * common >= self.lower * (a + b - common)


@functools.lru_cache(maxsize=8)
def bands(rule: Rule) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smallest size of each band, its number of segments and of segments a set may leave out.

    Linked sets lie in one band or in neighbouring ones.  Sets of one band, or of one and
    the band below, differ in at most d elements, so of d + 1 + spare segments at least
    1 + spare are equal.
    """
    lows = [rule.first]
    while lows[-1] < 2**31:
        lows.append(max(lows[-1] + 1, -(-lows[-1] * rule.upper // rule.lower)))
    lows = np.array(lows, np.int64)
    apart = rule.apart(2 * (lows[1:] - 1))
    spare = np.maximum(1, apart // 4)
    return lows[:-1], apart + 1 + spare, spare


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()
remembers("shingles", _WORDS.clear)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: close inputs give unrelated outputs."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    A-Z are lower-cased, words end at ASCII white space.  Fewer words than a shingle has
    are one shingle; no words are none.
    """
    found = (text or "").encode().lower().split()
    h = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    size = min(words, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        out = mixed(out + h[k : len(h) - size + 1 + k])
    return np.unique(out)


def set_key(elements: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(elements.tobytes()) - 2**63


def segment_keys(elements: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of the segments of a set, in its own band's layout and in the next band's.

    A segment's part of the parity sketch is named by the XOR of its elements' codes.  Sets
    leave out their smallest segments, as long as these are no more than the spare ones:
    of two sets the one that leaves out up to larger sizes leaves out at most as many
    equal segments as are spare, so one equal segment remains in both.
    """
    lows, segments, spares = bands(rule)
    if len(elements) < rule.first:
        return np.empty(0, np.uint64)
    own = int(np.searchsorted(lows, len(elements), "right")) - 1
    out = []
    for layout in (own, own + 1):
        count = int(segments[layout])
        segment = (elements >> np.uint64(11)) % np.uint64(count)
        order = np.argsort(segment)
        sizes = np.bincount(segment.astype(np.int64), minlength=count)
        fewest = np.sort(sizes)[int(spares[layout])]
        taken = np.flatnonzero(sizes >= fewest)
        filled = np.flatnonzero(sizes)
        starts = np.concatenate([[0], np.cumsum(sizes)])[filled]
        codes = np.zeros(count, np.uint64)
        codes[filled] = np.bitwise_xor.reduceat(mixed(elements[order]), starts)
        place = mixed(taken.astype(np.uint64) + np.uint64((layout + 1) << 32))
        out.append(mixed(codes[taken] ^ place))
    return np.concatenate(out)


def sketch(elements: np.ndarray, size: int = SKETCH_BITS) -> bytes:
    """Parity of the elements that fall on each of ``size`` bits."""
    bits = np.bincount((elements >> np.uint64(40)).astype(np.int64) % size, minlength=size)
    return np.packbits((bits & 1).astype(np.uint8)).tobytes()


def wide_sketch(elements: np.ndarray) -> bytes | None:
    """A sketch in proportion to a set that is too large for the common one; else none.

    Sets that differ in a fixed share of their elements differ in a fixed share of its bits,
    however large they are.
    """
    if len(elements) <= SKETCH_BITS:
        return None
    return sketch(elements, min(MOST_BITS, 1 << (len(elements) - 1).bit_length()))


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the size of the other."""
    x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)))
    return int(np.bitwise_count(x ^ y).sum())


def classes(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Documents whose shingle sets are equal are one class, named by a 64-bit hash of the
    set; only classes go on.  Every set files its id under the keys of its segments; linked
    sets share a key.  Sets under a key are first linked with the smallest of them, which
    settles groups of near copies without their pairs; then, under keys whose sets are not
    all connected yet, sets of different components are compared, by sketches in tiles
    and, if these and the wide ones allow a link, exactly.  No key is dropped or cut short.

    Null, empty and blank texts have no shingles and are linked with nothing.  A null
    doc_id is linked with nothing and keeps a null component.  Rows that share a doc_id
    are one vertex.  Other columns are ignored; an empty table gives an empty result.
    """
    ship_code(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    @F.pandas_udf("n long, key long, sketch binary, wide binary")
    def keyed(texts: pd.Series) -> pd.DataFrame:
        only_memory_of("shingles")
        out = []
        for text in texts:
            elements = shingles(text, rule.words)
            out.append((len(elements), set_key(elements), sketch(elements), wide_sketch(elements)))
        return pd.DataFrame(out, columns=["n", "key", "sketch", "wide"])

    rows = docs.select("doc_id", keyed("text").alias("set")).select("doc_id", "set.*")
    with small_batches(docs.sparkSession, TEXT_ROWS):
        rows = stored(rows, "sets")
    sets = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("key", "n")
    # Equal sets have equal sketches.
    sketches = [F.first(c).alias(c) for c in ("sketch", "wide")]
    sets = stored(sets.agg(F.min("doc_id").alias("first"), *sketches), "classes")
    with scratch(docs.sparkSession) as keep:
        links = stored(_links(docs, sets, rule), "set-links")
        found = keep(stored(components(links), "set-components"))
    found = found.select(F.col("id").alias("key"), "component")
    label = F.coalesce("component", "key").alias("component")
    sets = stored(sets.join(found, "key", "left").select("key", "n", "first", label), "labels")
    smallest = sets.groupBy("component").agg(F.min("first").alias("component_id"))
    named = sets.join(smallest, "component").select("key", "n", "component_id")
    out = rows.drop("sketch", "wide").withColumn("key", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.col("key")))
    out = out.join(named, ["key", "n"], "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _links(docs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) between set keys whose components are those of all links."""

    tables = max(LEAST_TABLES, round((sets.agg(F.sum("n")).first()[0] or 0) * _keys_per_element(rule) / TABLE_KEYS))

    def filed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only_memory_of("shingles")
        seen: set[int] = set()
        ids, keys, held = [], [], 0
        for batch in batches:
            for text in batch["text"]:
                elements = shingles(text, rule.words)
                key = set_key(elements)
                if key in seen or len(elements) < rule.first:
                    continue
                if len(seen) < SEEN:
                    seen.add(key)
                keys.append(segment_keys(elements, rule))
                ids.append(key)
                held += len(keys[-1])
                if held >= PACK_KEYS:
                    yield _packed(ids, keys, tables)
                    ids, keys, held = [], [], 0
        if ids:
            yield _packed(ids, keys, tables)

    spark = docs.sparkSession
    packs = docs.where("doc_id IS NOT NULL").select("text").mapInPandas(
        filed, "part int, keys binary, places binary, ids binary, centres binary"
    )
    members = packs.groupBy("part").applyInPandas(_members, "bucket long, id long, centre long")
    with small_batches(spark, TEXT_ROWS):
        members = stored(members, "members")
    pairs = members.where("id != centre").select(F.col("centre").alias("a"), F.col("id").alias("b"))
    stars = stored(pairs.distinct(), "stars")
    # Sketches rule most pairs out that share a key by chance, so that only the elements of
    # sets which may be linked are made, kept and moved.
    marks = sets.select(F.col("key").alias("id"), "n", "sketch")
    pairs = stored(_sketched(stored(_alike(stars, sets, rule), "alike"), marks, rule), "near")
    pairs = _wide_sketched(pairs, sets, rule)
    held = _held(docs, sets, _ends(pairs), rule)

    # Most sets are settled by the smallest set they share a key with.
    nearest = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links, tried = _checked(nearest, held, rule), nearest
    # Of the other pairs only those count that would connect something.
    left = _apart(pairs, links.where("linked")).join(tried, ["a", "b"], "left_anti")
    links = links.union(_checked(left, held, rule))
    # Pairs whose sizes or sketches forbid a link stand here too: their sets may be linked with others.
    left = stored(_apart(stars, links.where("linked")), "apart")
    if left.isEmpty():
        return links.where("linked").select("a", "b")

    # Keys with a pair that is not connected may still hold links between others of their sets.
    keys = members.join(left, (F.col("centre") == F.col("a")) & (F.col("id") == F.col("b"))).select("bucket")
    keys = stored(keys.distinct(), "open-keys")
    wanted = stored(members.join(keys, "bucket").select("bucket", "id").distinct(), "open-members")
    # Two sets alone under a key are a pair that is decided already.
    counts = wanted.groupBy("bucket").agg(F.count("*").alias("about")).where("about > 2")
    wanted = stored(wanted.join(counts, "bucket"), "open-groups")
    pairs = _compared(wanted, _labels(links.where("linked")), marks, rule).join(links, ["a", "b"], "left_anti")
    pairs = _wide_sketched(stored(pairs, "open-near"), sets, rule)
    more = stored(_ends(pairs).join(held.select("id"), "id", "left_anti"), "more-ids")
    if not more.isEmpty():
        held = held.unionByName(_held(docs, sets, more, rule))
    return links.union(_checked(pairs, held, rule)).where("linked").select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()


def _labels(links: DataFrame) -> DataFrame:
    return components(links.select("a", "b"))


def _apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs whose two sets are not connected by the links."""
    label = _labels(links)
    named = pairs
    for end in ("a", "b"):
        own = label.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}"))
        named = named.join(own, end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    return named.where("of_a != of_b").select("a", "b")


def _keys_per_element(rule: Rule) -> float:
    """Keys that a set files for each of its elements, about: in two layouts."""
    return 2.4 * (rule.upper - rule.lower) / (rule.upper + rule.lower) * 2


def _packed(ids: list[int], keys: list[np.ndarray], tables: int) -> pd.DataFrame:
    """Keys of many sets, one row for each table that some of them belong to.

    Keys that several of the sets share are settled here: their members are sent as such,
    and only the smallest of them goes on, so a key of very many sets is one entry of each
    pack.  A table is a range of keys; within it 40 bits tell keys apart.
    """
    set_of = np.repeat(np.array(ids, np.int64), [len(k) for k in keys])
    key = np.concatenate(keys)
    order = np.lexsort((set_of, key))
    key, set_of = key[order], set_of[order]
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(start, len(key)))
    shared = np.repeat(sizes > 1, sizes)
    bounds = np.array([t * 2**64 // tables for t in range(tables)], np.uint64)
    rows = []
    mine, members, centres = key[shared], set_of[shared], np.repeat(set_of[start], sizes)[shared]
    for t, part in _ranges(mine, bounds):
        rows.append((t, _five(mine[part]), None, members[part].tobytes(), centres[part].tobytes()))
    key, set_of = key[start], set_of[start]
    for t, part in _ranges(key, bounds):
        known, place = np.unique(set_of[part], return_inverse=True)
        kind = np.uint16 if len(known) < 2**16 else np.uint32
        rows.append((t, _five(key[part]), place.astype(kind).tobytes(), known.tobytes(), None))
    return pd.DataFrame(rows, columns=["part", "keys", "places", "ids", "centres"])


def _ranges(keys: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, slice]]:
    cuts = np.append(np.searchsorted(keys, bounds), len(keys)).tolist()
    for t in range(len(bounds)):
        if cuts[t] < cuts[t + 1]:
            yield t, slice(cuts[t], cuts[t + 1])


def _five(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _wide(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(packed, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<i8")


def _members(rows: pd.DataFrame) -> pd.DataFrame:
    """Members of the keys of one table that several sets share, each with the smallest set."""
    keys, ids, out = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
    for packed, places, known, centres in zip(rows["keys"], rows["places"], rows["ids"], rows["centres"]):
        known = np.frombuffer(known, np.int64)
        if centres is not None:
            out.append((_wide(packed), known, np.frombuffer(centres, np.int64)))
            continue
        key = _wide(packed)
        keys.append(key)
        ids.append(known[np.frombuffer(places, np.uint16 if len(places) == 2 * len(key) else np.uint32)])
    key, ids = np.concatenate(keys), np.concatenate(ids)
    order = np.lexsort((ids, key))
    key, ids = key[order], ids[order]
    if len(key):
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(start, len(key)))
        shared = np.repeat(sizes > 1, sizes)
        out.append((key[shared], ids[shared], np.repeat(ids[start], sizes)[shared]))
    part = int(rows["part"].iloc[0]) << 40
    found = [np.concatenate([o[n] for o in out]) if out else np.empty(0, np.int64) for n in range(3)]
    return pd.DataFrame({"bucket": found[0] + part, "id": found[1], "centre": found[2]})


def _held(docs: DataFrame, sets: DataFrame, ids: DataFrame, rule: Rule) -> DataFrame:
    """(id, elements) of the wanted set keys, made from one document of each."""
    spark = docs.sparkSession
    wanted = stored(ids.join(sets, F.col("id") == F.col("key")).select("id", "first"), "wanted")
    if wanted.count() <= MOST_SENT:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted.withColumnRenamed("first", "doc_id"), "doc_id").select("id", "text")

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t, rule.words) for t in batch["text"]]
            out = [(i, s.tobytes()) for i, s in zip(batch["id"], found) if set_key(s) == i]
            yield pd.DataFrame(out, columns=["id", "elements"])

    held = texts.mapInPandas(made, "id long, elements binary")
    with small_batches(spark, SET_ROWS):
        return stored(held.dropDuplicates(["id"]), "held")


def _alike(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sizes allow a link."""
    sizes = sets.select("key", "n")
    pairs = pairs.join(sizes.select(F.col("key").alias("a"), F.col("n").alias("na")), "a")
    pairs = pairs.join(sizes.select(F.col("key").alias("b"), F.col("n").alias("nb")), "b")
    alike = F.least("na", "nb") * rule.upper >= F.greatest("na", "nb") * rule.lower
    return pairs.where(alike).select("a", "b")


def _sketched(pairs: DataFrame, marks: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sketches allow a link."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                x, y = (np.frombuffer(b"".join(rows[c]), np.uint64).reshape(len(rows), -1) for c in "xy")
                differ = np.bitwise_count(x ^ y).sum(1)
                yield rows[differ <= rule.apart((rows["na"] + rows["nb"]).to_numpy())][["a", "b"]]

    left = marks.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("x"))
    right = marks.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(near, "a long, b long")


def _wide_sketched(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose wide sketches allow a link; those of which one set has none stay."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            most = rule.apart((rows["na"] + rows["nb"]).fillna(0).to_numpy().astype(np.int64))
            stay = [
                x is None or y is None or differing(x, y) <= m for x, y, m in zip(rows["x"], rows["y"], most.tolist())
            ]
            yield rows.loc[np.array(stay, bool), ["a", "b"]]

    wide = sets.where("wide IS NOT NULL")
    left = wide.select(F.col("key").alias("a"), F.col("n").alias("na"), F.col("wide").alias("x"))
    right = wide.select(F.col("key").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("y"))
    with small_batches(pairs.sparkSession, SET_ROWS):
        return stored(pairs.join(left, "a", "left").join(right, "b", "left").mapInPandas(near, "a long, b long"), "pairs")


def _checked(pairs: DataFrame, held: DataFrame, rule: Rule) -> DataFrame:
    """The pairs with ``linked``: whether the sets themselves reach the threshold."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            linked = []
            for x, y in zip(rows["x"], rows["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]), kind="stable")
                linked.append(rule.linked(int((both[1:] == both[:-1]).sum()), len(x), len(y)))
            yield pd.DataFrame({"a": rows["a"], "b": rows["b"], "linked": np.array(linked, bool)})

    pairs = stored(pairs, "to-check")
    # Few pairs go to the sets, so that only the sets of pairs are moved.
    near = F.broadcast(pairs) if pairs.count() <= MOST_PAIRS_SENT else pairs
    left = held.select(F.col("id").alias("a"), F.col("elements").alias("x")).join(near, "a")
    right = held.select(F.col("id").alias("b"), F.col("elements").alias("y")).join(near, "b")
    found = left.join(right, ["a", "b"]).select("a", "b", "x", "y")
    with small_batches(pairs.sparkSession, SET_ROWS):
        return stored(found.mapInPandas(compared, "a long, b long, linked boolean"), "checked")


def _compared(members: DataFrame, label: DataFrame, marks: DataFrame, rule: Rule) -> DataFrame:
    """Distinct pairs of one bucket and different components whose sketches allow a link.

    Members are rows of (bucket, id, about): the number of the bucket's rows.
    """
    groups = F.ceil(F.col("about") / BUCKET_ROWS).cast("int")
    cut = members.withColumn("groups", groups).withColumn("own", F.pmod(F.xxhash64("id"), F.col("groups")).cast("int"))
    tiles = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("tile"),
        F.when(F.col("own") != F.col("other"), F.col("own")).otherwise(-1).alias("side"),
        "id",
    )
    tiles = stored(tiles, "tiles")
    calls = task_count(tiles.count(), CALL_ROWS, LEAST_TABLES)

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        return _compare(rows, rule)

    named = marks.join(label, "id", "left")
    named = named.withColumn("component", F.coalesce("component", "id"))
    call = F.pmod("tile", F.lit(calls).cast("long")).alias("call")
    return tiles.join(named, "id").groupBy(call).applyInPandas(compared, "a long, b long").distinct()


def _compare(rows: pd.DataFrame, rule: Rule) -> pd.DataFrame:
    rows = rows.sort_values(["tile", "id"])
    tile, side, ids, component, n = (rows[c].to_numpy() for c in ("tile", "side", "id", "component", "n"))
    bits = np.frombuffer(b"".join(rows["sketch"]), np.uint64).reshape(len(rows), SKETCH_BITS // 64)
    left, shift, out = np.arange(len(rows)), 0, [np.empty((0, 2), np.int64)]
    while len(left):
        shift += 1
        left = left[left + shift < len(rows)]
        left = left[tile[left] == tile[left + shift]]
        for at in range(0, len(left), 100_000):
            a = left[at : at + 100_000]
            b = a + shift
            ok = ((side[a] == -1) | (side[a] != side[b])) & (component[a] != component[b])
            ok &= np.minimum(n[a], n[b]) * rule.upper >= np.maximum(n[a], n[b]) * rule.lower
            a, b = a[ok], b[ok]
            differ = np.bitwise_count(bits[a] ^ bits[b]).sum(1)
            ok = differ <= rule.apart(n[a] + n[b])
            if ok.any():
                out.append(np.sort(np.stack([ids[a[ok]], ids[b[ok]]], 1), 1))
    found = np.unique(np.concatenate(out), axis=0)
    return pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})


def one_of_each(docs: DataFrame, rule: Rule) -> DataFrame:
    """The documents that stay when one of each group of near duplicates does: the smallest id.

    Equal rows, which share their id and text, are copies too: one of them stays.  Rows
    without shingles or without an id all stay.
    """
    groups = stored(classes(docs, rule), "groups")
    dropped = groups.where("component_id != doc_id").select("doc_id").distinct()
    kept = docs.join(dropped, "doc_id", "left_anti")
    repeated = groups.where("n_shingles > 0").groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL")
    repeated = stored(repeated.select("doc_id"), "repeated")
    if repeated.isEmpty():
        return kept
    copies = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(copies)


def op9_shingle_join(spark: SparkSession, folder: str) -> DataFrame:
    return classes(table(spark, folder, "documents"), Rule(words=3, lower=90, upper=100))


SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS shingle
  FROM cut
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM sets p JOIN sets q
    ON p.shingle = q.shingle AND p.doc_id <> q.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
  SELECT a AS id, b AS other FROM links
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a
), firsts AS (
  SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN firsts f ON d.doc_id = f.id
"""
