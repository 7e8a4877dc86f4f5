"""A corpus pipeline: language, toxicity, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again as
the next one's ``docs``; all but the last return the columns of ``docs``.

language  rows whose text is in none of the learned languages, or holds no letter, go; where no
          row names a language nothing can be learned, and all rows stay
toxicity  rows that score as toxic go
near_duplicates  one row of each group stays, that of the smallest key; equal rows stay once
personal_data  personal data in texts become pseudonyms, and ``n_chars`` follows the text
packing   one row for each piece of a packed window

Null and empty texts go with the first stage.  Null keys are keys like any other.  Any further
columns are carried along.  Empty tables pass through as such.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, langid, packing, pii, queries, toxicity
from tidemark.llm.common import table
from tidemark.sources.scratch import materialise

LEAST_LANGUAGE = 0.28  # share of a text's n-grams that its language must contain


def _placed(docs: DataFrame, column: str = "text") -> tuple[DataFrame, str]:
    """Columns named by place, so that an operator's own names cannot clash with them."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), f"c{docs.columns.index(column)}"


def _restored(placed: DataFrame, docs: DataFrame) -> DataFrame:
    return placed.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = langid.learn(docs)
    if not filters.languages:
        return docs
    placed, text = _placed(docs)
    said = langid.with_language(placed, filters, text=text)
    return _restored(said.where((F.col("lang_pred") != langid.UNKNOWN)
                                & (F.col("score") >= LEAST_LANGUAGE)), docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    placed, text = _placed(docs)
    scored = toxicity.with_score(placed, lexicon, text=text)
    return _restored(scored.where(F.col("tox_score") < queries.TOXIC), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed, text = _placed(docs)
    ident = F.struct(F.col(f"c{docs.columns.index('doc_id')}").alias("id"),
                     F.xxhash64(text).alias("body"))
    grouped = materialise(
        jaccard.join(placed.select(ident.alias("key"), F.col(text).alias("text")), key="key")
        .select("key", F.col("key").eqNullSafe(F.col("component_id")).alias("stays")),
        "pipeline-groups")
    # A row goes by its key and text; rows equal in both are left to the last step.
    name = F.xxhash64(F.col("key.id"), F.col("key.id").isNull(), F.col("key.body"))
    gone = materialise(grouped.where(~F.col("stays")).select(name.alias("name")).distinct(),
                       "pipeline-gone")
    again = (grouped.where("stays").groupBy(name.alias("name")).count().where("count > 1")
             .select("name"))
    placed = placed.withColumn("name", F.xxhash64(
        ident["id"], ident["id"].isNull(), ident["body"]))
    kept = jaccard.without(placed, gone)
    again = materialise(again, "pipeline-again")
    if not again.isEmpty():
        kept = kept.join(again, "name", "left_anti").unionByName(
            kept.join(again, "name", "left_semi").dropDuplicates(["name"]))
    return _restored(kept, docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed, text = _placed(docs)
    made = pii.pseudonymise(placed, queries.PII_KEY, text=text)
    if "n_chars" in docs.columns:
        at = docs.columns.index("n_chars")
        made = made.withColumn(f"c{at}", F.when(
            F.col("n_pii") > 0, F.length(text)).otherwise(F.col(f"c{at}"))
            .cast(docs.schema[at].dataType))
    return _restored(made, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("toxicity", toxic), ("near_duplicates", near_duplicates),
    ("personal_data", personal_data), ("packing", packed)]

# Models and hashes in the stages have no SQL.  Tests hold the rows of every stage against a plain
# loop over a table with nulls, repeated keys and clashing columns.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
