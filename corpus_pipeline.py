"""A corpus pipeline: each stage applies one text operator to all that the one before kept.

Stages take ``(spark, docs, sf_dir)``. Between stages the documents are written as Parquet to the
shared folder and read again, so a lost executor costs no earlier stage. All stages but the last
return the columns of ``documents``; the last returns the pieces of documents in their bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordflow.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from recordflow.llm.common import written
from recordflow.session import configure

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, by a model of the labelled ones that aren't held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.fit(docs, labels)).select(DOCUMENTS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines they share with earlier ones.

    A document that loses all its text is a copy and goes; ``n_chars`` follows the text.
    """
    left = line_dedup.dedup(docs, gone_column="_gone")
    text_left = F.trim(F.coalesce("text", F.lit(""))) != ""
    return left.filter(F.col("_gone").isNull() | text_left).withColumn("n_chars", F.length("text").cast("long")).select(DOCUMENTS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest ID."""
    return jaccard_join.keep_one(docs).select(DOCUMENTS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(DOCUMENTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document, in bins without two of a source or of a set of copies."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("packing", pack),
]

# Alignment, hashing of bands and best fit have no SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
