from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_helpers import PROSE

from pyspark.sql import functions as F

from pedalflow.llm import langid
from pedalflow.llm.queries import op1_language_id


def plain_model(words: Counter, order: int):
    """Interpolated Kneser-Ney written out with dictionaries."""
    seen = defaultdict(Counter)
    left = defaultdict(set)
    for word, n in words.items():
        symbols = "^" + word + "^"
        for i in range(1, len(symbols)):
            for k in range(1, order + 1):
                if i - k + 1 < 0:
                    break
                gram = symbols[i - k + 1 : i + 1]
                longest = k == order or i - k + 1 == 0
                if longest:
                    seen[k][gram if k == order else "0" + gram] += n
                else:
                    left[gram].add(symbols[i - k])
    counts = {k: Counter() for k in range(1, order + 1)}
    counts[order].update(seen[order])
    for k in range(1, order):
        for gram, n in seen[k].items():
            counts[k][gram[1:]] += n
        for gram, before in left.items():
            if len(gram) == k:
                counts[k][gram] += len(before)
    figures = {}
    for k, c in counts.items():
        once, twice = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        d = max(langid.DISCOUNT_FLOOR, once / (once + 2 * twice) if once else langid.DISCOUNT_FLOOR)
        total, taken = Counter(), Counter()
        for gram, v in c.items():
            total[gram[:-1]] += v
            taken[gram[:-1]] += min(v, d)
        figures[k] = (c, d, total, taken)
    uniform = 1 / (1 + len(counts[1]))

    def bits(word: str) -> float:
        symbols, out = "^" + word + "^", 0.0
        for i in range(1, len(symbols)):
            p = uniform
            for k in range(1, order + 1):
                if i - k + 1 < 0:
                    break
                gram = symbols[i - k + 1 : i + 1]
                c, d, total, taken = figures[k]
                v, t = c.get(gram, 0), total.get(gram[:-1], 0)
                p = (v - min(v, d)) / t + taken[gram[:-1]] / t * p if t else p
            out -= math.log2(p)
        return out

    return bits


def test_the_model_is_interpolated_kneser_ney():
    texts = [" ".join(PROSE.values()), "a aa aaa banana bandana night"]
    words = langid.distinct_words(texts)
    counts = np.bincount(words.at, minlength=len(words.offsets) - 1)
    model = langid.fit(words, counts)
    names = [k.decode("utf-32-le") for k in words.keys]
    by_hand = plain_model(Counter(dict(zip(names, counts.tolist()))), langid.ORDER)
    probe = langid.distinct_words(["river nights zebra a bananas unseen x " + " ".join(names)])
    got = langid.word_bits([model], probe)[0]
    for key, value in zip(probe.keys, got):
        assert value == pytest.approx(by_hand(key.decode("utf-32-le")), rel=1e-4)


def test_words_are_runs_of_letters():
    words = langid.distinct_words(["It's 2 l8, ÉTÉ-été", "", "!?"])
    keys = [k.decode("utf-32-le") for k in words.keys]
    assert [[keys[i] for i in words.at[a:b]] for a, b in zip(words.text_offsets, words.text_offsets[1:])] == [
        ["it", "s", "l", "été", "été"], [], []
    ]


def test_the_query_predicts_held_out_documents(spark, documents):
    got = {r.doc_id: r for r in op1_language_id(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= got[d.doc_id].score <= 1
    held = [d for d in docs if got[d.doc_id].held_out]
    right = sum(got[d.doc_id].lang_pred == d.lang for d in held) / len(held)
    assert len(held) > 150 and right > 0.98
    assert sum(r.rejected for r in got.values()) < 0.005 * len(docs)


def test_rejection_and_memory(documents, monkeypatch):
    known = langid.learn(documents)
    assert known.languages == ["de", "en", "es", "fr"]
    names, score, rejected = known.predict(["", "12 !", "qzxv kjwq zzzxq vbnmq xkcdq qqqq wwwz xjq pqkz"])
    assert names[:2] == ["und", "und"] and score[:2].tolist() == [0, 0] and rejected.all()
    texts = [r.text for r in documents.limit(30).collect()]
    monkeypatch.setattr(langid, "KNOWN_WORDS", 50)
    memory = langid.Memory(4)
    for _ in range(2):
        for text in texts:
            with_memory, without = known.predict([text], memory), known.predict([text])
            assert with_memory[0] == without[0] and with_memory[1] == pytest.approx(without[1])


def test_awkward_rows(awkward, empty, documents):
    known = langid.learn(awkward)
    assert known.languages == ["de", "en", "xx"]
    got = langid.identify(awkward, known).collect()
    assert len(got) == awkward.count()
    for r in got:
        if r.doc_id in (4, 5, 6):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 9}) == 1
    kept = langid.accepted(awkward, known)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()}.isdisjoint({4, 5, 6})
    nothing = langid.learn(empty)
    assert nothing.languages == [] and langid.identify(empty, nothing).collect() == []
    assert {r.lang_pred for r in langid.identify(awkward, nothing).collect()} == {"und"}
    assert langid.accepted(empty, nothing).columns == empty.columns and langid.accepted(awkward, nothing).isEmpty()


def test_the_sample_is_bounded(documents, monkeypatch):
    sampled = langid.sample(documents, chars=20_000).groupBy("lang").agg({"text": "count"}).collect()
    whole = {r.lang: r["count"] for r in documents.groupBy("lang").count().collect()}
    assert all(r["count(text)"] <= whole[r.lang] for r in sampled) and sum(r["count(text)"] for r in sampled) < 130
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    known = langid.learn(documents)
    assert len(known.languages) == 2
    assert {r.lang_pred for r in langid.identify(documents, known).collect()} <= {*known.languages, "und"}


def test_no_language_is_lost(spark, documents):
    """Texts that are all longer than a piece, and a language that is mostly copies of one text."""
    texts = {lang: [r.text for r in documents.filter(F.col("lang") == lang).collect()] for lang in ("en", "fr", "de")}
    long = " ".join(texts["fr"])
    rows = [(i, "fr", " ".join([long] * (150_000 // len(long) + 1)) + str(i)) for i in range(30)]
    rows += [(100 + i, "en", t) for i, t in enumerate(texts["en"][:29])]
    copied, other = texts["de"][0], texts["de"][1:12]
    rows += [(1000 + i, "de", copied) for i in range(3000)] + [(5000 + i, "de", t) for i, t in enumerate(other)]
    known = langid.learn(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))
    assert known.languages == ["de", "en", "fr"]
    held = [(t, lang) for lang in texts for t in texts[lang][30:50] if len(t) > 40]
    names, _, _ = known.predict([t for t, _ in held])
    assert sum(a == b for a, (_, b) in zip(names, held)) > 0.95 * len(held)
