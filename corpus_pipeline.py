"""A corpus pipeline: the stages turn documents into token ids in training order. Each stage is one operator of sieveline.llm.

Defined cases, for every stage: rows with a null doc_id are kept where their text allows; a null or empty text is scored by the classifier
as any other, is no near copy, holds no secret, has no words and is therefore not mixed in; equal rows count as one document from the
near-duplicate stage on (without doc_id: each for itself); very long texts are processed whole; an empty table gives an empty table; columns beyond
those of documents pass through all stages but the last, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import bpe, curriculum, minmax_dedup, quality_gbdt, secret_scan
from sieveline.llm.shared import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. Equal texts have equal scores; without labels all are accepted."""
    return quality_gbdt.select_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id; rows without doc_id all stay."""
    return minmax_dedup.deduplicate(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the kind of each secret in its place; n_chars, where there is one, follows the text (0 for null)."""
    redacted = secret_scan.redact(docs)
    if "n_chars" not in docs.columns:
        return redacted
    return redacted.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them whole (never, if they have no word), in training order; null is a source too."""
    return curriculum.arrange(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, and whether decoding gave the text again; one row for each row, null text counts as empty."""
    done = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)
    return done.select("doc_id", "n_tokens", "ids", "ids_sha256", F.col("same").alias("decoded_same"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("tokens", tokens)]

#: A trained classifier and a tokenizer are beyond SQL; tests hold run() against plain Python from the classifier's decisions on.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
