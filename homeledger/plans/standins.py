"""Stand-in tables derived from the test tables (FIXTURES.md §3).

``orders`` plays the model registry and the trial log; cleaned listings with
``list_price`` as the prediction of ``sold_price`` play a stored prediction
table.  Each has a Spark builder and the same definition as DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homeledger.operators.clean import clean_data
from homeledger.schema import LISTING_KEYS
from homeledger.sources.fixture import listings, read_table

SCORE = "(CAST(floor(o_totalprice) AS BIGINT) % 10000) / 10000.0"


def _score():
    return (F.floor("o_totalprice").cast("bigint") % 10000) / F.lit(10000.0)


def versions(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    return o.select((F.col("o_orderkey") + 1).alias("version"),
                    F.when(F.col("o_orderstatus") == "F", "rf").otherwise("gbt").alias("model_type"),
                    _score().alias("cv_adj_r2"),
                    F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
                    (F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                            "CAST(o_orderdate AS TIMESTAMP_NTZ))") + F.col("o_orderkey")).alias("creation_timestamp"))


VERSIONS_SQL = (f"versions AS (SELECT o_orderkey + 1 AS version, CASE WHEN o_orderstatus = 'F' THEN 'rf' "
                f"ELSE 'gbt' END AS model_type, {SCORE} AS cv_adj_r2, 'run-' || CAST(o_orderkey AS VARCHAR) "
                f"AS run_id, epoch_ms(o_orderdate) + o_orderkey AS creation_timestamp FROM orders)")


def trials(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    s = _score()
    return o.select(F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
                    (F.col("o_custkey") % 50).cast("int").alias("trial_number"),
                    F.when(F.col("o_orderstatus") == "F", "rf").otherwise("gbt").alias("model_type"),
                    F.col("o_orderdate").alias("start_time"),
                    s.alias("cv_adj_r2_mean"), ((F.col("o_orderkey") % 100) / F.lit(1000.0)).alias("cv_adj_r2_std"),
                    (s + F.lit(0.01)).alias("cv_r2_mean"), (F.col("o_totalprice") / 10).alias("cv_rmse_mean"),
                    (F.col("o_totalprice") / 100).alias("cv_rmse_std"), (F.col("o_totalprice") / 20).alias("cv_mae_mean"))


TRIALS_SQL = (f"trials AS (SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id, CAST(o_custkey % 50 AS INTEGER) "
              f"AS trial_number, CASE WHEN o_orderstatus = 'F' THEN 'rf' ELSE 'gbt' END AS model_type, "
              f"o_orderdate AS start_time, {SCORE} AS cv_adj_r2_mean, (o_orderkey % 100) / 1000.0 AS cv_adj_r2_std, "
              f"{SCORE} + 0.01 AS cv_r2_mean, o_totalprice / 10 AS cv_rmse_mean, o_totalprice / 100 AS cv_rmse_std, "
              f"o_totalprice / 20 AS cv_mae_mean FROM orders)")


def stored_predictions(spark: SparkSession, sf: str) -> DataFrame:
    c = clean_data(listings(spark, sf))
    return c.select(*LISTING_KEYS, F.col("sold_price").alias("actual"), F.col("list_price").alias("predicted"),
                    ((F.col("l_orderkey") + F.col("l_linenumber")) % 5).cast("int").alias("fold"))


PREDICTIONS_SQL = ("preds AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sold_price AS actual, "
                   "list_price AS predicted, CAST((l_orderkey + l_linenumber) % 5 AS INTEGER) AS fold FROM cleaned)")
