from __future__ import annotations

import math

import numpy as np
import pytest

from pedalflow.llm import vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def by_hand(rows):
    """Links and components by comparing all pairs in double precision."""
    flat = []
    for k, r in enumerate(rows):
        v = r.embedding
        if r.vec_id is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = np.array(v, np.float64)
            v = v / np.abs(v).max()
            flat.append((k, r.vec_id, v / np.linalg.norm(v)))
    parent = {r.vec_id: r.vec_id for r in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = {}
    for k, i, v in flat:
        for m, j, w in flat:
            if m != k and len(v) == len(w) and v @ w >= 0.9:
                links[k] = links.get(k, 0) + 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted(
        ((i, links.get(k, 0), None if i is None else find(i), i is None or find(i) == i) for k, i in enumerate(r.vec_id for r in rows)),
        key=str,
    )


def answer(df):
    return sorted(map(tuple, vectors.near_vectors(df).collect()), key=str)


def clustered(rng, n, dim, spread):
    centers = rng.standard_normal((12, dim))
    return (centers[rng.integers(0, 12, n)] + spread * rng.standard_normal((n, dim))).astype(np.float32)


def test_close_groups_by_hand(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(clustered(rng, 400, 64, 0.05))]
    rows += [(1000 + i, v.tolist(), 1) for i, v in enumerate(rng.standard_normal((100, 64)).astype(np.float32))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert answer(df) == by_hand(df.collect())


def test_hot_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BUCKET_BLOCK", 30)
    monkeypatch.setattr(vectors, "PAIR_SLICE", 500)
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(clustered(rng, 300, 32, 0.05))], SCHEMA)
    assert answer(df) == by_hand(df.collect())


def test_recall_at_the_asked_cosine(spark):
    """Pairs whose cosine lies just above the limit are the hardest to find."""
    rng = np.random.default_rng(5)
    one = rng.standard_normal((1500, 64))
    one /= np.linalg.norm(one, axis=1)[:, None]
    side = rng.standard_normal((1500, 64))
    side -= (side * one).sum(1)[:, None] * one
    side /= np.linalg.norm(side, axis=1)[:, None]
    two = 0.902 * one + math.sqrt(1 - 0.902**2) * side
    rows = [(2 * i, a.tolist(), 0) for i, a in enumerate(one)] + [(2 * i + 1, b.tolist(), 0) for i, b in enumerate(two)]
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    found = sum(got[2 * i + 1].component_id == 2 * i for i in range(1500))
    assert found >= 0.97 * 1500


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    expected, got = by_hand(df.collect()), answer(df)
    links = sum(r[1] for r in expected)
    assert sum(r[1] for r in got) >= 0.98 * links and all(g[1] <= e[1] for g, e in zip(got, expected))
    assert np.mean([g[2] == e[2] for g, e in zip(got, expected)]) > 0.99


def test_an_id_with_several_vectors(spark):
    near = lambda v: [x + 0.01 for x in v]
    x, y, z = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    rows = [(1, x, 0), (1, y, 0), (2, near(x), 0), (3, near(y), 0), (4, near(y), 0), (5, z, 0), (6, x, 0), (1, x, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert answer(df) == by_hand(df.collect())


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (2, [2.0, 0.0, 0.0], 0), (3, [1.0, 0.0], 0), (4, [1.0, 0.001], 0),
        (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0), (8, [nan, 1.0, 0.0], 0), (9, [inf, 0.0, 0.0], 0), (10, [None, 1.0, 0.0], 0),
        (None, [1.0, 0.0, 0.0], 0), (11, [1e-30, 0.0, 0.0], 0), (12, [3e38, 0.0, 0.0], 0), (13, [-1.0, 0.0, 0.0], None),
        (14, [-0.0, 1.0, 0.0], 0), (15, [0.0, 1.0, 0.0], 0), (16, [1.0], 0), (17, [2.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "copies", "raw", "table", "root", "links", "_vector", "_same"):
        df = df.withColumn(name, df["label"])
    assert answer(df) == by_hand(df.collect())
    assert answer(df.filter("false")) == []


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(6)
    u = rng.standard_normal((4000, 64))
    u /= np.linalg.norm(u, axis=1)[:, None]
    codes = vectors.Codes(u)
    i, j = np.arange(2000), np.arange(2000, 4000)
    error = codes.estimates(i, j) - (u[i] * u[j]).sum(1)
    assert abs(error.mean()) < 0.01
    assert (np.abs(error) <= codes.bound[i]).all()


@pytest.mark.parametrize("n", [1, 500, 10_000, 50_000, 10**9])
def test_table_shape(n):
    bits, tables = vectors.table_shape(n)
    agree = (1 - math.acos(0.9) / math.pi) ** bits
    assert (1 - agree) ** tables <= vectors.MISS and 2**bits <= max(n, 64)
