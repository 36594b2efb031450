"""A corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chartmill.llm import language, mixing, neardup, secrets, tokens
from chartmill.llm.base import small_batches, table, written
from chartmill.llm.queries import LEVELS, VOCABULARY, WEIGHTS, with_domain

# A text that shares less than this with the order of every language is in none of them.
LEAST_SCORE = 0.2
# Of all tokens that reach the mixing stage, this share is its budget; no document is taken twice.
SHARE = 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no language the corpus knows.  Labels are used to learn, not to decide."""
    small_batches(spark)
    profiles = language.fit(docs.where(~language.held_out("doc_id")))
    found = language.predict(docs, profiles, out="_language")
    sure = (F.col("_language.lang") != language.UNDETERMINED) & (F.col("_language.score") >= LEAST_SCORE)
    return found.where(sure).drop("_language")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    small_batches(spark)
    return neardup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the text; every document stays."""
    small_batches(spark)
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Choose documents so that domains, languages and sources come close to their weights."""
    small_batches(spark)
    return mixing.mix(with_domain(docs), LEVELS, WEIGHTS, share=SHARE, max_epochs=1, seed=7).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and the text they decode to."""
    small_batches(spark)
    coded = tokens.encode(docs, VOCABULARY, decoded="decoded")
    return coded.select("doc_id", "lang", "source", F.expr("length(ids) div 4").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("bpe", encode_tokens),
]

# Rank distances, signatures and merges are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
