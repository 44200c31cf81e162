"""Queries for sources 1, cleaning 13-19, 26 and the cleaning log 35."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger.operators import clean as C
from homeledger.plans.registry import register
from homeledger.plans.sqlbits import all_null_pred, iqr_ctes, qlist, with_cleaned, with_listings
from homeledger.schema import LISTING_COLUMNS, OUTLIER_COLUMNS, VALID_STYLES
from homeledger.sources import io
from homeledger.sources.fixture import listings, read_table

ALL = ", ".join(LISTING_COLUMNS)


def _with_empty_rows(spark, sf):
    """Listings plus one all-null row per region (planted for drop_empty_rows)."""
    lst = listings(spark, sf)
    empties = read_table(spark, sf, "region").select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in lst.schema.fields])
    return lst.unionByName(empties)


EMPTY_ROWS_SQL = "src AS (SELECT * FROM listings UNION ALL SELECT " + ", ".join(
    f"NULL AS {c}" for c in LISTING_COLUMNS) + " FROM region)"


@register("read_listings", lambda: with_listings() + f"SELECT {ALL} FROM listings")
def q_read_listings(spark, sf):
    return io.read_listings(spark, io.materialize_listings_csv(spark, sf), fmt="csv")


@register("drop_empty_rows", lambda: with_listings(EMPTY_ROWS_SQL) +
          f"SELECT * FROM src WHERE NOT ({all_null_pred()})")
def q_drop_empty_rows(spark, sf):
    return C.drop_empty_rows(_with_empty_rows(spark, sf))


@register("deduplicate", lambda: with_listings() +
          "SELECT DISTINCT * FROM (SELECT * FROM listings UNION ALL SELECT * FROM listings)")
def q_deduplicate(spark, sf):
    lst = listings(spark, sf)
    return C.deduplicate(lst.unionByName(lst))


@register("remove_missing_target", lambda: with_listings() +
          "SELECT * FROM listings WHERE sold_price IS NOT NULL")
def q_remove_missing_target(spark, sf):
    return C.remove_missing_target(listings(spark, sf))


@register("filter_style", lambda: with_listings() +
          f"SELECT * FROM listings WHERE style IN ({qlist(VALID_STYLES)}) OR style IS NULL")
def q_filter_style(spark, sf):
    return C.filter_style(listings(spark, sf))


def _outlier_sql(src_cte: str, mult: float = 1.5) -> str:
    sels = []
    for c in OUTLIER_COLUMNS:
        sels.append(f"""SELECT '{c}' AS "column",
  CAST(count(*) FILTER (WHERE NOT COALESCE((v_{c} >= {c}__lo AND v_{c} <= {c}__hi) OR v_{c} IS NULL, TRUE)) AS BIGINT) AS outliers_found,
  round(any_value({c}__lo), 2) AS lower_bound, round(any_value({c}__hi), 2) AS upper_bound,
  round(any_value({c}__q1), 2) AS q1, round(any_value({c}__q3), 2) AS q3,
  round(any_value({c}__q3) - any_value({c}__q1), 2) AS iqr
FROM t, b""")
    qs = ", ".join(f"quantile_cont(TRY_CAST({c} AS DOUBLE), 0.25) AS {c}__q1, "
                   f"quantile_cont(TRY_CAST({c} AS DOUBLE), 0.75) AS {c}__q3" for c in OUTLIER_COLUMNS)
    bs = ", ".join(f"{c}__q1, {c}__q3, {c}__q1 - {mult}*({c}__q3-{c}__q1) AS {c}__lo, "
                   f"{c}__q3 + {mult}*({c}__q3-{c}__q1) AS {c}__hi" for c in OUTLIER_COLUMNS)
    vs = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS v_{c}" for c in OUTLIER_COLUMNS)
    return (f"q AS (SELECT {qs} FROM {src_cte}), b AS (SELECT {bs} FROM q), "
            f"t AS (SELECT {vs} FROM {src_cte})"), "\nUNION ALL\n".join(sels)


@register("remove_outliers_iqr", lambda: with_listings(iqr_ctes("listings", "kept")) +
          f"SELECT {ALL} FROM kept")
def q_remove_outliers_iqr(spark, sf):
    return C.remove_outliers_iqr(listings(spark, sf))


def _outlier_report_sql():
    ctes, body = _outlier_sql("listings")
    return with_listings(ctes) + body


@register("outlier_report", _outlier_report_sql)
def q_outlier_report(spark, sf):
    return C.outlier_report(listings(spark, sf))


@register("clean_pipeline", lambda: with_cleaned() + f"SELECT {ALL} FROM cleaned")
def q_clean_pipeline(spark, sf):
    return C.clean_data(listings(spark, sf))


@register("coerce_numeric", lambda: with_listings() +
          "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
          "TRY_CAST(list_date AS DOUBLE) AS list_date_num, TRY_CAST(zip_code AS DOUBLE) AS zip_num, "
          "TRY_CAST(beds AS DOUBLE) AS beds FROM listings")
def q_coerce_numeric(spark, sf):
    df = listings(spark, sf).select(*C_KEYS, F.col("list_date").alias("list_date_num"),
                                    F.col("zip_code").alias("zip_num"), "beds")
    return C.coerce_numeric(df, ["list_date_num", "zip_num", "beds"])


C_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _cleaning_log_sql():
    return with_cleaned() + f"""
SELECT CAST((SELECT count(*) FROM listings) AS BIGINT) AS raw_rows,
  {len(LISTING_COLUMNS)} AS raw_columns,
  CAST((SELECT count(*) FROM listings) - (SELECT count(*) FROM s1) AS BIGINT) AS empty_rows_dropped,
  CAST((SELECT count(*) FROM s1) - (SELECT count(*) FROM s2) AS BIGINT) AS duplicates_dropped,
  CAST((SELECT count(*) FROM s2) - (SELECT count(*) FROM s3) AS BIGINT) AS missing_target_dropped,
  CAST((SELECT count(*) FROM s3) - (SELECT count(*) FROM s4) AS BIGINT) AS style_filter_dropped,
  CAST((SELECT count(*) FROM s4) - (SELECT count(*) FROM cleaned) AS BIGINT) AS outliers_dropped,
  CAST((SELECT count(*) FROM cleaned) AS BIGINT) AS cleaned_rows,
  CAST((SELECT count(*) FROM listings) - (SELECT count(*) FROM cleaned) AS BIGINT) AS total_rows_removed,
  round(100.0 * ((SELECT count(*) FROM listings) - (SELECT count(*) FROM cleaned))
        / greatest((SELECT count(*) FROM listings), 1), 2) AS removal_pct
"""


@register("cleaning_log", _cleaning_log_sql)
def q_cleaning_log(spark, sf):
    return C.cleaning_log(listings(spark, sf))
