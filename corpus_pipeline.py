"""Training-corpus pipeline: recognised language, not toxic, one of each near-duplicate group, packed.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from homeledger.llm import packing, ppm, simhash, string_kernel
from homeledger.llm.queries import word_tokenizer
from homeledger.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of a learned language stay."""
    return ppm.keep_identified(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts scored below 0.5 stay."""
    return string_kernel.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at two bits or fewer stays."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed into sequences of at most 2048 tokens."""
    return packing.pack(docs, word_tokenizer())


STAGES = [("language_id", language_id), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("pack", pack)]

# Fitted models and a tokenizer decide what stays: SQL cannot say the same.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
