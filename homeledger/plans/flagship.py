"""The flagship query: cleaned listings profiled by style."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeledger.functions.quantiles import exact_quantiles
from homeledger.operators.clean import clean_data
from homeledger.sources.fixture import listings


def style_price_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_data(listings(spark, sf_dir))
    # rows without a style are a group of their own in this report
    named = cleaned.withColumn("key", F.struct(F.col("style")))
    mid = exact_quantiles(named, ["sold_price"], [0.5], by=["key"])
    return (named.groupBy("key").agg(F.count(F.lit(1)).alias("listings")).join(mid, "key", "left")
            .select(F.col("key.style").alias("style"), "listings",
                    F.round(F.col("__q_sold_price")[0], 2).alias("median_sold_price"))
            .orderBy(F.col("style").asc_nulls_first()))
