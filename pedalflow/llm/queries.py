"""The operators applied to the given tables, by name, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalflow.llm import alignment, exact, langid, lattice, minhash, mixing, neighbours, notices, pages, pieces, repair, shards, vectors

VOCABULARY, BYTE_VOCABULARY = "piece_bpe_32k.model", "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    known = langid.learn(docs.filter(langid.learnable()))
    held_out = F.coalesce(~langid.learnable(), F.lit(False)).alias("held_out")
    return langid.identify(docs, known).select("doc_id", held_out, "lang_pred", "score", "rejected")


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.token_counts(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.encode(_table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op4_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "pages")
    return pages.extract(given, pages.learn(given))


def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, folder, "embeddings"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(_table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shard(_table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return notices.licenses(_table(spark, folder, "documents")).withColumn("spans", F.to_json("spans"))


def op10_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), size=3, percent=85)


def op11_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(_table(spark, folder, "embeddings"))


def op12_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return alignment.align(docs, public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(VOCABULARY))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations")
    return repair.report(given, repair.damaged(given))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_token_counts": op2_token_counts,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_html_extraction": op4_html_extraction,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_license_scan": op9_license_scan,
    "op10_minhash_dedup": op10_minhash_dedup,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_conversation_repair": op13_conversation_repair,
}

# Components by following links both ways; for the small tables that SQL is run on.
_COMPONENTS = """
reach(a, b) AS (
  SELECT id, id FROM members
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
component AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""

SQL: dict[str, str] = {
    "op5_embedding_dedup": f"""
WITH RECURSIVE members AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings),
links AS (
  SELECT x.id AS a, y.id AS b FROM members x JOIN members y
    ON x.id <> y.id AND list_inner_product(x.v, y.v) / sqrt(list_inner_product(x.v, x.v) * list_inner_product(y.v, y.v)) >= 0.9),
{_COMPONENTS}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE links.a = component.id) AS n_links, component_id, id = component_id AS kept
FROM component
""",
    "op10_minhash_dedup": rf"""
WITH RECURSIVE split AS (
  SELECT doc_id AS id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: list_slice(w, i, i + 2))
                                  WHEN len(w) > 0 THEN [w] ELSE [] END) AS s FROM split),
members AS (SELECT split.id, count(s) AS n FROM split LEFT JOIN shingles USING (id) GROUP BY split.id),
common AS (
  SELECT x.id AS a, y.id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN members x ON x.id = a JOIN members y ON y.id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_COMPONENTS}
SELECT id AS doc_id, n AS n_shingles, component_id, id = component_id AS kept FROM component JOIN members USING (id)
""",
    # The exact neighbours; the query finds them all where its index has one part, as on small tables.
    "op11_nearest_neighbours": """
WITH members AS (
  SELECT DISTINCT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
scored AS (
  SELECT q.id AS query_id, m.id AS vec_id,
         list_reduce(list_transform(list_zip(q.v, m.v), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
  FROM members q JOIN members m ON q.id % 20 = 0 AND q.id <> m.id AND len(q.v) = len(m.v)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, place::INT AS rank, vec_id, score FROM ranked WHERE place <= 20
""",
    "op6_exact_dedup": r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY t)
""",
}
