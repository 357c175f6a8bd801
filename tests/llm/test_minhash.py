from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from pedalflow.llm import links, minhash

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def set_of(text, size):
    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)}


def by_hand(rows, size, percent):
    """Set size and component of every doc_id, by comparing all pairs that share a shingle."""
    sets = [(r.doc_id, set_of(r.text, size)) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        if i is None:
            continue
        common = Counter(j for g in s for j in holders[g])
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
        for g in s:
            holders[g].append(k)
    return sorted(((i, len(s), find(i) if i is not None else None, i is None or find(i) == i) for i, s in sets), key=str)


def answer(docs, size, percent):
    return sorted(map(tuple, minhash.near_duplicates(docs, size, percent).collect()), key=str)


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def copies(spark):
    """A large group of near copies that are not all near each other, pairs, exact copies and a shared passage."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(60)]
    texts = [" ".join(edited(base, rng, rng.randrange(8))) for _ in range(150)]
    texts += [" ".join(passage + [word() for _ in range(120)]) for _ in range(100)]
    for _ in range(60):
        one = [word() for _ in range(rng.randrange(3, 200))]
        texts += [" ".join(one), "  ".join(edited(one, rng, rng.randrange(4))).upper()]
    texts += ["two words"] * 40 + ["", None, "one", "One"]
    rng.shuffle(texts)
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_groups_by_hand(copies, size, percent):
    assert answer(copies, size, percent) == by_hand(copies.collect(), size, percent)


def test_blocks_of_a_hot_group_lose_nothing(copies, monkeypatch):
    monkeypatch.setattr(minhash, "KEY_BLOCK", 20)
    monkeypatch.setattr(minhash, "SET_BLOCK", 3000)
    assert answer(copies, 3, 85) == by_hand(copies.collect(), 3, 85)


def test_the_documents(spark, documents):
    for size, percent in ((3, 85), (5, 80)):
        assert answer(documents, size, percent) == by_hand(documents.collect(), size, percent)


def test_awkward_rows(awkward, empty):
    got = answer(awkward, 3, 85)
    assert got == by_hand(awkward.collect(), 3, 85)
    left = minhash.without_near_duplicates(awkward)
    assert left.columns == awkward.columns
    # 2 and 8 repeat 1 and 7; the text of 9 is there twice, and once without id.
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 3, 4, 5, 6, 7, 9, 10, 11]
    assert answer(empty, 3, 85) == [] and minhash.without_near_duplicates(empty).collect() == []


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_signatures_within_the_distance_share_a_key(percent):
    """The pigeonhole promise, for the most adverse places of the errors."""
    rng = np.random.default_rng(1)
    distance = minhash.max_distance(percent)
    bounds = minhash.chunk_bounds(distance)
    for trial in range(300):
        one = rng.integers(0, 1 << 16, minhash.HASHES).astype(np.uint16)
        other = one.copy()
        if trial % 2:
            places = rng.choice(minhash.HASHES, distance, replace=False)
        else:  # the errors dealt evenly over the chunks
            chunks = [list(rng.permutation(np.arange(a, b))) for a, b in zip(bounds, bounds[1:])]
            places = [c[k] for k in range(minhash.HASHES) for c in chunks if k < len(c)][:distance]
        other[places] ^= 1
        keys = minhash.index_keys(np.stack([one, other]), bounds)
        assert set(keys[0]) & set(keys[1])


def test_signature_distance_follows_similarity():
    rng = np.random.default_rng(2)
    shared, a, b = (rng.integers(0, 1 << 52, n).astype(np.uint64) for n in (850, 75, 75))
    flat = np.concatenate([np.sort(np.concatenate([shared, x])) for x in (a, b)])
    sigs = minhash.signatures(flat, np.array([0, 925, 1850]))
    assert (sigs[0] != sigs[1]).sum() <= minhash.max_distance(85)
    assert (minhash.signatures(flat[:0], np.array([0, 0])) == 0).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \nA\x0b\x1f é"), max_size=12), min_size=1, max_size=5), st.integers(1, 4))
def test_shingle_sets(texts, size):
    values, offsets = minhash.shingle_sets([t.encode() for t in texts], size)
    got = [set(values[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
    expected = [set_of(t, size) for t in texts]
    assert [len(g) for g in got] == [len(e) for e in expected]
    for i in range(len(texts)):
        for j in range(i):
            assert len(got[i] & got[j]) == len(expected[i] & expected[j])


def test_components_within():
    near = {(0, 1), (1, 2), (4, 5)}
    linked = lambda i, rest: np.array([(min(i, j), max(i, j)) in near for j in rest.tolist()], bool)
    label = links.components_within(6, linked)
    assert label.tolist() == [0, 0, 0, 3, 4, 4]
    src, dst = links.stars(np.array([50, 40, 30, 20, 10, 11]), label)
    assert sorted(zip(src, dst)) == [(11, 10), (40, 30), (50, 30)]


def test_rows_go_by_id_and_text(spark):
    """A doc_id with a second text, texts of a group under one id, and rows that repeat both."""
    words = [f"w{i}" for i in range(60)]
    near = " ".join(words[:-1] + ["other"])
    nearer = " ".join(words[:-1] + ["another"])
    alone = " ".join(f"z{i}" for i in range(40))
    rows = [(1, " ".join(words)), (9, " ".join(words)), (9, alone), (5, near), (5, near), (1, near), (3, alone + " end"), (None, " ".join(words)), (None, alone), (7, "")]
    rows += [(7, "")] + [(20, "a text of its own that is twice there with its id")] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("source", F.monotonically_increasing_id())
    left = sorted(((r.doc_id or 0), r.text) for r in minhash.without_near_duplicates(docs).collect())
    first = min((" ".join(words), near), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert left == sorted([(1, first), (3, alone + " end"), (7, ""), (7, ""), (20, rows[-1][1])])
    apart = spark.createDataFrame([(1, " ".join(words)), (9, nearer), (9, "quite another text without any near one")], docs.schema[:2])
    assert sorted(r.doc_id for r in minhash.without_near_duplicates(apart).collect()) == [1, 9]
