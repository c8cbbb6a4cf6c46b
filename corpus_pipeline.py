"""Documents to packed training sequences: each stage takes what the one before it kept.

Every stage takes and returns rows with the columns of ``documents``, but for the
last, which returns the pieces of sequences. ``n_chars`` follows the text. Stages
handle null ids, texts and sources, empty texts, repeated rows and empty tables as
their operators say; other columns travel with their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sondaflow.llm import dedup, mixing, packing, quality, queries, secrets
from sondaflow.llm.tables import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others keep the lines that passed.

    A kept document is unfolded to its row, a rejected one to none: a filter would be pushed below the
    rules and make them all over again for its condition.
    """
    judged = quality.judged(docs.select(F.struct(*docs.columns).alias("doc"), F.col("text")))
    row = F.struct(*(
        F.col("clean_text").alias(c) if c == "text" else
        F.length("clean_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col(f"doc.{c}").alias(c) for c in docs.columns))
    return judged.select(F.inline(F.when(F.col("kept"), F.array(row))))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity 0.8."""
    return dedup.one_of_each(docs, words=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, with a mask in place of its secrets."""
    found = secrets.with_spans(docs.select(F.struct(*docs.columns).alias("doc"), F.col("text")), out="__spans")
    text = secrets.redacted(F.col("text"), F.col("__spans"))
    return found.withColumn("__clean", text).select(*(
        F.col("__clean").alias(c) if c == "text" else
        F.length("__clean").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else
        F.col(f"doc.{c}") for c in docs.columns))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words taken of each document, as one row per run; twice where the mix takes them twice."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens, with their ids."""
    return packing.packed(docs, queries.tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("secret_scan", secret_scan),
          ("source_mix", source_mix), ("pack", pack)]
ORACLE_SQL = None  # tests/llm compares the stages with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
