"""Registered queries: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, fingerprints, hardneg, itq, jaccard, langid, packing, pii, resample, secrets, sharding,
    topk, toxicity,
)
from tidemark.llm.common import held_out, table

SHARDS = 16
PII_KEY = b"tidemark-demonstration-key"
TOXIC = 0.3
PERCENT = 25
SPECIAL = {"<|endoftext|>": 50256}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.round_trip(table(spark, sf_dir, "documents"),
                                      tokenizer("word_bpe_49k.json")))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = sharding.assign(table(spark, sf_dir, "documents"), [1.0] * SHARDS,
                               grown=[1.0] * (SHARDS + 1))
    return sharding.with_slots(assigned).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
        "grown_shard")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    lexicon = toxicity.learn(documents, table(spark, sf_dir, "labels"))
    return toxicity.with_score(documents.select("doc_id", "text"), lexicon).select(
        "doc_id", held_out().alias("held_out"), F.col("tox_score").alias("score"),
        (F.col("tox_score") >= TOXIC).cast("int").alias("predicted"))


def op7_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return langid.with_language(
        documents.select("doc_id", "text"), langid.learn(documents)).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


def pack_documents(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    return packing.pack(documents, tokenizer("byte_bpe_50k.tiktoken"),
                        public_tokenizers.PATTERN, SPECIAL, tokenizer("byte_bpe_50k.json"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(pack_documents(table(spark, sf_dir, "documents")))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), PERCENT).select(
        "doc_id", "n_features", "weight", "score", "rank")


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_bpe, op2_sharding, op3_topk, op4_pii, op5_secrets, op6_toxicity, op7_itq,
        op8_language, op9_packing, op10_jaccard, op11_hard_negatives, op12_resample,
        op13_fingerprints)}


# Vectors of null or non-finite components take no part, and a row is not its own candidate.
TOPK_SQL = """
WITH given AS (
    SELECT row_number() OVER () AS place, vec_id,
           [floor(256 * x::DOUBLE) for x in embedding] AS vector
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
    SELECT q.place, q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(q.vector, c.vector) AS BIGINT) AS score
    FROM given AS q JOIN given AS c
      ON len(q.vector) = len(c.vector) AND q.place <> c.place
    WHERE q.vec_id % 50 = 0),
ranked AS (
    SELECT query_id, vec_id, score, CAST(row_number() OVER (
        PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS LAST) AS INTEGER) AS rank
    FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

HARD_NEGATIVES_SQL = """
WITH given AS (
    SELECT row_number() OVER () AS place, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) for x in embedding] AS vector
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
    SELECT a.place, a.vec_id AS anchor_id, r.place AS other, r.vec_id, a.label = r.label AS same,
           CAST(list_inner_product(a.vector, r.vector) AS BIGINT) AS score
    FROM given AS a JOIN given AS r
      ON len(a.vector) = len(r.vector) AND a.place <> r.place
    WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY place ORDER BY score DESC, vec_id ASC NULLS LAST) AS n
        FROM pairs WHERE same)
    WHERE n <= 5),
ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
           CAST(row_number() OVER (PARTITION BY p.place, p.other
                ORDER BY n.score DESC, n.vec_id ASC NULLS LAST) AS INTEGER) AS rank,
           p.score AS positive_score, n.score AS negative_score
    FROM positives AS p JOIN pairs AS n
      ON p.place = n.place AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND n.score <= p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": TOPK_SQL, "op11_hard_negatives": HARD_NEGATIVES_SQL}
