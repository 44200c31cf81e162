"""Registered queries of the operators: whole tables in, digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.separator_scan import token_counts

    # the vocabulary ends at 49407, so no text gives this id
    return token_counts(_table(spark, sf_dir, "documents"), word_tokenizer(), end_id=49408)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), word_tokenizer())


def op3_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.ppm import identify

    return identify(_table(spark, sf_dir, "documents"))


def op4_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.importance import resample

    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.quality_rules import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents"))


def op6_pigeonhole_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.pigeonhole import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op7_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.string_kernel import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.cross_entropy import cross_entropy_difference

    return cross_entropy_difference(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.piece_viterbi import round_trip

    return round_trip(_table(spark, sf_dir, "documents"), piece_model())


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.fill_middle import digests

    return digests(_table(spark, sf_dir, "documents"), seed=7, rate=100, spm=50)


def op12_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.block_anchors import digests

    return digests(_table(spark, sf_dir, "documents"), window=50)


def op13_cover_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    from homeledger.llm.cover_lloyd import digests

    return digests(_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        op1_separator_scan, op2_packing, op3_ppm_language, op4_importance, op5_quality_rules,
        op6_pigeonhole_join, op7_string_kernel, op8_cross_entropy, op9_piece_viterbi, op10_simhash,
        op11_fill_middle, op12_block_anchors,
        op13_cover_lloyd)}


def oracle_sql() -> dict[str, str]:
    from homeledger.llm import block_anchors, cover_lloyd, cross_entropy, fill_middle, pigeonhole, quality_rules

    return {"op5_quality_rules": quality_rules.duck_sql(), "op6_pigeonhole_join": pigeonhole.duck_sql(),
            "op8_cross_entropy": cross_entropy.duck_sql(), "op11_fill_middle": fill_middle.duck_sql(),
            "op12_block_anchors": block_anchors.duck_sql(),
            "op13_cover_lloyd": cover_lloyd.duck_sql()}
