"""Near vectors and nearest neighbours against every pair."""

import math

import numpy as np
import pytest

from narrowlake.llm import near_vectors, nearest


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


@pytest.fixture(scope="module")
def rows(vectors):
    return [(i, v) for i, v in vectors.select("vec_id", "embedding").collect()]


def test_near_vectors_equal_all_pairs(vectors, rows):
    got = sorted(
        (tuple(r) for r in near_vectors.near_duplicates(vectors).collect()), key=lambda r: (r[0] is None, r)
    )
    n = len(rows)
    links = [[] for _ in rows]
    for a in range(n):
        for b in range(n):
            (i, v), (j, w) = rows[a], rows[b]
            if a != b and i is not None and j is not None and usable(v) and usable(w) and len(v) == len(w):
                v, w = np.array(v, float), np.array(w, float)
                if v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.9:
                    links[a].append(b)
    want = []
    for a, (i, _) in enumerate(rows):
        reach, todo = {a}, [a]
        while todo:
            new = set(links[todo.pop()]) - reach
            reach |= new
            todo += new
        least = None if i is None else min(rows[b][0] for b in reach)
        want.append((i, len(links[a]), least, i is None or least == i))
    assert got == sorted(want, key=lambda r: (r[0] is None, r))
    assert sum(r[1] for r in want) > 20


def test_recall_grows_with_tables():
    for rows in (100, 10_000, 10**9):
        projections, tables = near_vectors.tables_for(rows, 0.9)
        chance = near_vectors.same_cell(math.sqrt(0.2), near_vectors.WIDTH) ** projections
        assert 1 - (1 - chance) ** tables >= near_vectors.RECALL
        apart = near_vectors.same_cell(math.sqrt(2), near_vectors.WIDTH) ** projections
        assert rows * apart <= 1.0001


def test_large_buckets_are_cut_without_loss(spark):
    """2,500 vectors around one direction: more than a bucket's tile."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=16) + 0.05 * rng.normal(size=(2_500, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(frame).collect()}
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.95 * want.sum()
    assert {r["component_id"] for r in got.values()} == {0}


def test_nearest_equals_all_distances(vectors, rows):
    asked = vectors.where("vec_id % 100 = 0")
    got = [tuple(r) for r in nearest.nearest(vectors, asked).collect()]
    points = {(i, tuple(v)) for i, v in rows if i is not None and usable(v)}
    want = []
    for q in sorted({i for i, _ in points if i % 100 == 0}):
        found = set()
        for i, v in (p for p in points if p[0] == q):
            for j, w in points:
                if j != q and len(v) == len(w):
                    found.add((math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w))), j))
        want += [(q, r, j, d) for r, (d, j) in enumerate(sorted(found)[:10], 1)]
    assert [r[:3] for r in sorted(got)] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in sorted(got)], [r[3] for r in want], rtol=1e-12)


def test_ties_go_to_the_smaller_id_and_few_candidates_all_come(spark):
    rows = [(0, [0.0, 1.0])] + [(i, [1.0, 0.0]) for i in (5, 3, 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest.nearest(frame, frame.where("vec_id = 0"), k=2).orderBy("rank").collect()
    assert [(r["rank"], r["vec_id"]) for r in got] == [(1, 3), (2, 5)]
    assert nearest.nearest(frame, frame.where("vec_id = 0"), k=10).count() == 3


def test_empty_tables(vectors):
    none = vectors.limit(0)
    assert near_vectors.near_duplicates(none).collect() == []
    assert nearest.nearest(none, none).collect() == []


def test_nearest_with_components_of_any_size(spark):
    """Vectors of 1e-300 beside one of 1e200, whose squares overflow."""
    rows = [(i, [x * (1 + i / 7), x * (2 - i / 9), x]) for x in (1e-3, 1.0) for i in range(int(x * 10) * 10, int(x * 10) * 10 + 9)]
    rows += [(200, [1e200, 0.0, 1e200]), (201, [3e200, 0.0, 1e200])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest.nearest(frame, frame.where("vec_id % 100 = 0"), k=3)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in found.collect()}
    for query, v in rows:
        if query % 100:
            continue
        with np.errstate(over="ignore"):
            near = sorted((float(np.sqrt(np.sum((np.array(v) - np.array(w)) ** 2))), i) for i, w in rows if i != query)
        for rank in (1, 2, 3):
            score, vec_id = near[rank - 1]
            assert got[query, rank][0] == vec_id and got[query, rank][1] == pytest.approx(score)
