"""Learned partitions against a search of all pairs."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from pedalflow.llm import neighbours
from pedalflow.llm.queries import op11_nearest_neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def product(v, w):
    total = 0.0
    for a, b in zip(v, w):
        total += a * b
    return total


def by_hand(rows, k=20, every=20):
    """All pairs, in plain Python sums for small tables."""
    flat = {}
    for r in rows:
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            flat[(r.vec_id, tuple(float(x) + 0.0 for x in v))] = None
    found = []
    for i, v in flat:
        if i % every == 0:
            near = sorted((-product(v, w), j) for j, w in flat if (j, w) != (i, v) and len(w) == len(v))
            found += [(i, rank, j, -s) for rank, (s, j) in enumerate(near[:k], 1)]
    return sorted(found)


def answer(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


def recall(got, rows, k=20):
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in rows}
    ids = np.array(sorted(vectors))
    base = np.stack([vectors[i] for i in ids])
    hits = total = 0
    lists = {}
    for q, _, v, s in got:
        lists.setdefault(q, []).append((v, s))
    assert set(lists) == {i for i in ids.tolist() if i % 20 == 0}
    for q, near in lists.items():
        products = base @ vectors[q]
        products[ids == q] = -np.inf
        assert len(near) == min(k, len(ids) - 1) and len({v for v, _ in near}) == len(near)
        assert all(abs(s - vectors[q] @ vectors[v]) < 1e-9 and v != q for v, s in near)
        assert all(a[1] >= b[1] for a, b in zip(near, near[1:]))
        true = np.sort(products)[-k:][0]
        hits += sum(s >= true - 1e-12 for _, s in near)
        total += len(near)
    return hits / total


def clustered(rng, n, dim, centers, spread):
    middle = rng.standard_normal((centers, dim))
    return (middle[rng.integers(0, centers, n)] + spread * rng.standard_normal((n, dim))).astype(np.float32)


def frame(spark, vectors):
    return spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], SCHEMA)


def test_small_tables_are_searched_whole(spark):
    df = frame(spark, clustered(np.random.default_rng(1), 300, 16, 10, 0.3))
    assert answer(neighbours.nearest(df)) == by_hand(df.collect())


@pytest.mark.parametrize("spread,scale", [(0.05, False), (0.5, False), (0.5, True), (50.0, False)])
def test_recall_of_learned_parts(spark, spread, scale):
    """Close clusters, wide clusters, vectors of very different lengths, and no clusters at all."""
    rng = np.random.default_rng(2)
    vectors = clustered(rng, 6000, 32, 40, spread)
    if scale:
        vectors *= rng.lognormal(0, 0.7, (6000, 1)).astype(np.float32)
    df = frame(spark, vectors)
    assert recall(answer(neighbours.nearest(df, part_rows=150)), df.collect()) >= 0.9


def test_a_clustered_table_is_searched_in_few_parts():
    vectors = clustered(np.random.default_rng(3), 8000, 32, 60, 0.3).astype(np.float64)
    router = neighbours.fit(vectors, 8000, part_rows=250)
    assert router.parts == 32 and router.probes <= 6 and router.recall >= neighbours.TARGET


def test_parts_are_balanced_and_follow_the_graph():
    vectors = clustered(np.random.default_rng(4), 2000, 16, 8, 0.1).astype(np.float64)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    links = neighbours.nearest_in(vectors, 10)
    part = neighbours.balanced_parts(links, 3)
    assert sorted(Counter(part.tolist()).values()) == [250] * 8
    assert (part[links] == part[:, None]).mean() > 0.8


def test_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    assert recall(answer(op11_nearest_neighbours(spark, "/root/testdata/sf0.1")), rows) >= 0.95


def test_blocks_change_nothing(spark, monkeypatch):
    df = frame(spark, clustered(np.random.default_rng(5), 400, 8, 5, 0.4))
    expected = by_hand(df.collect())
    monkeypatch.setattr(neighbours, "BASE_BLOCK", 37)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    assert answer(neighbours.nearest(df)) == expected


def test_ties_and_copies(spark):
    """One vector in a third of the rows, and vectors of equal products: the smaller ids come first."""
    one = np.eye(6, dtype=np.float32)
    vectors = [one[0] if i % 3 == 0 else one[1 + i % 5] * (1 + i % 2) for i in range(240)]
    df = frame(spark, vectors)
    assert answer(neighbours.nearest(df)) == by_hand(df.collect())


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0], 0), (20, [2.0, 0.0, 0.0], 0), (20, [2.0, 0.0, 0.0], 0), (20, [0.0, 3.0, 0.0], 0), (3, [1.0, 0.0], 0),
        (40, [1.0, 0.001], 0), (5, None, 0), (60, None, 0), (6, [], 0), (80, [0.0, 0.0, 0.0], 0), (8, [nan, 1.0, 0.0], 0),
        (100, [inf, 0.0, 0.0], 0), (10, [None, 1.0, 0.0], 0), (None, [1.0, 0.0, 0.0], 0), (11, [1e-30, 0.0, 0.0], 0),
        (12, [3e38, 0.0, 0.0], 0), (13, [-1.0, 0.0, 0.0], None), (14, [-0.0, 1.0, 0.0], 0), (15, [0.0, 1.0, 0.0], 0), (-20, [1.0], 0),
        (120, [7.0, 7.0, 7.0, 7.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "ids", "asks", "part", "vector", "identity", "rank", "score", "own", "near", "_rank"):
        df = df.withColumn(name, df["label"])
    assert answer(neighbours.nearest(df)) == by_hand(df.collect())
    assert neighbours.nearest(df.filter("false")).collect() == []


def test_double_vectors_of_great_length(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.integers(-100, 100)).tolist(), 0) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got, expected = answer(neighbours.nearest(df)), by_hand(df.collect())
    assert [g[:3] for g in got] == [e[:3] for e in expected]
