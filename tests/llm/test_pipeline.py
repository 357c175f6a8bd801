from __future__ import annotations

import duckdb
import pytest
import public_tokenizers
import sentencepiece
from llm_helpers import FOLDER
from test_exact_shards_mixing import groups_by_hand
from test_minhash import by_hand

import corpus_pipeline
from pedalflow.llm import langid
from pedalflow.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.01"


def plain(rows, columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=str)


@pytest.mark.parametrize("name", list(SQL))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    relation = con.sql(SQL[name])
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(relation.columns)
    theirs = [dict(zip(relation.columns, r)) for r in relation.fetchall()]
    assert plain(got.collect(), sorted(got.columns)) == plain(theirs, sorted(got.columns))


@pytest.mark.parametrize("name", [q for q in QUERIES if not q.startswith(("op11", "op13"))])  # of these other tests count the rows
def test_every_query_returns_every_row(spark, name):
    table = {"op4_html_extraction": "pages", "op5_embedding_dedup": "embeddings"}.get(name, "documents")
    assert QUERIES[name](spark, FOLDER).count() == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()


def test_the_stages_one_by_one(spark):
    """Each stage against its definition on what the one before it left."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = docs.collect()
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    known = langid.learn(docs)
    rejected = {d.doc_id for d, bad in zip(given, known.predict([d.text or "" for d in given])[2]) if bad}
    kept = stages["language_id"](spark, docs, SMALL)
    rows = kept.collect()
    assert kept.columns == columns and {r.doc_id for r in rows} == {d.doc_id for d in given} - rejected
    assert len(rejected) < 0.005 * len(given)

    left = stages["exact_dedup"](spark, kept, SMALL)
    expected = {g[0] for g in groups_by_hand(rows) if g[3]}
    rows = left.collect()
    assert left.columns == columns and {r.doc_id for r in rows} == expected

    apart = stages["near_dedup"](spark, left, SMALL)
    expected = {g[0] for g in by_hand(rows, corpus_pipeline.SHINGLE_WORDS, corpus_pipeline.SIMILAR_PERCENT) if g[3]}
    rows = apart.collect()
    assert apart.columns == columns and {r.doc_id for r in rows} == expected

    mixed = stages["mixed"](spark, apart, SMALL)
    assert mixed.columns == columns and plain(mixed.collect(), columns) == plain(rows, columns)
    # Each source has its share of the first half, while all have rows.
    first = [r.source for r in mixed.collect()[: len(rows) // 2]]
    sizes = {s: sum(r.source == s for r in rows) for s in set(first)}
    weights = {s: n**0.7 for s, n in sizes.items()}
    for s, w in weights.items():
        assert abs(first.count(s) - w / sum(weights.values()) * len(first)) <= 9

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.VOCABULARY))
    encoded = {r.doc_id: r for r in stages["encoded"](spark, mixed, SMALL).collect()}
    assert len(encoded) == len(rows)
    for r in rows:
        assert encoded[r.doc_id].token_ids == library.encode(r.text) and encoded[r.doc_id].round_trip

    whole = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.token_ids) for r in whole) == sorted((i, r.token_ids) for i, r in encoded.items())


def test_stages_on_awkward_and_empty_tables(spark, awkward, empty):
    for docs in (awkward, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns and out.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()
