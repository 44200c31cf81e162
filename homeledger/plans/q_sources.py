"""Queries for sources and sinks (2, 3, 6, 8-10) and the run summary (64)."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger.operators import clean as C
from homeledger.operators import quality as Q
from homeledger.operators import review as RV
from homeledger.plans.q_clean import _cleaning_log_sql
from homeledger.plans.q_review import STAMP, TS1, _label, _report_ctes
from homeledger.plans.registry import register
from homeledger.plans.sqlbits import with_cleaned, with_listings
from homeledger.schema import LISTING_COLUMNS, OUTLIER_COLUMNS, VALID_STYLES
from homeledger.session import scratch_path, scratch_scope
from homeledger.sources import io
from homeledger.sources.fixture import listings

ALL = ", ".join(LISTING_COLUMNS)
AS_OF = "1998-08-02"
CLEAN_METRICS = ["raw_rows", "empty_rows_dropped", "duplicates_dropped", "missing_target_dropped",
                 "style_filter_dropped", "outliers_dropped", "cleaned_rows", "total_rows_removed", "removal_pct"]
SKIP_PARAMS = ["outlier_columns"]


@register("pull_listings", lambda: with_listings() +
          f"SELECT {ALL} FROM listings WHERE city = 'NATION_3' AND state = 'OH' AND status = 'SOLD' AND "
          f"TRY_CAST(list_date AS DATE) >= DATE '{AS_OF}' - INTERVAL 365 DAY AND "
          f"TRY_CAST(list_date AS DATE) <= DATE '{AS_OF}'")
def q_pull_listings(spark, sf):
    """Over the stored listing table, so city/state/status reach the Parquet scan."""
    stored = io.read_listings(spark, io.materialize_listings_parquet(spark, sf), fmt="parquet")
    return io.pull_listings(stored, "NATION_3, OH", "sold", 365, AS_OF)


@register("write_snapshot", lambda: with_listings() +
          f"SELECT county, replace(replace(trim(county || ', OH'), ',', ''), ' ', '_') || '_365d_{STAMP}' AS snapshot, "
          f"'validated_' || replace(replace(trim(county || ', OH'), ',', ''), ' ', '_') || '_365d_{STAMP}' "
          f"AS validated_name, count(*) AS rows FROM listings GROUP BY county")
def q_write_snapshot(spark, sf):
    snap = _label(listings(spark, sf))
    path = io.write_snapshot(snap, scratch_path(spark, "snapshots"), "cleaned")
    back = io.read_snapshots(spark, path, "cleaned")
    return back.groupBy("snapshot").agg(F.first("county").alias("county"), F.count(F.lit(1)).alias("rows")).select(
        "county", "snapshot", io.stage_name("validated", F.col("snapshot")).alias("validated_name"), "rows")


@register("latest_snapshot", lambda: with_cleaned() + f"SELECT {ALL}, 'ALL_OH_365d_{STAMP}' AS snapshot FROM cleaned")
def q_latest_snapshot(spark, sf):
    base = scratch_path(spark, "stage")
    lst = listings(spark, sf)
    older = _label(lst).withColumn("snapshot", F.concat(F.lit("old_"), F.col("snapshot")))
    io.write_snapshot(older, base, "cleaned")
    with scratch_scope(spark):  # what is published is read from the store
        io.write_snapshot(_label(C.clean_data(lst)).withColumn("snapshot", F.lit(f"ALL_OH_365d_{STAMP}")), base, "cleaned")
    return io.latest_snapshot(spark, base, "cleaned")


@register("read_reports", lambda: with_cleaned(*_report_ctes()) +
          "SELECT snapshot, success, evaluated, passed, failed, timestamp, row_count, "
          f"{len(LISTING_COLUMNS)} AS column_count, dataset_hash, data_path, failed_expectations FROM run1")
def q_read_reports(spark, sf):
    """#8 + #9: write the per-snapshot reports as JSON, leave a half-written run, read back."""
    from homeledger.schema import VALIDATION_REPORT_SCHEMA
    path = scratch_path(spark, "reports")
    reports = RV.validation_reports(_label(listings(spark, sf)), TS1)
    for _ in range(2):  # a rerun adds nothing
        io.write_reports(reports, path, "run-reports")
    spark.createDataFrame([("{not json",)], "value string").write.text(f"{path}/data/version=killed/run_id=run-killed")
    found = io.read_reports(spark, path, VALIDATION_REPORT_SCHEMA)
    return found.withColumn("failures", F.array_join(F.transform("failures", lambda f: f["expectation"]), ", ")
                            ).withColumnRenamed("failures", "failed_expectations")


CLEAN_PARAMS = {"iqr_multiplier": 1.5, "location": "Cincinnati, OH", "valid_styles": list(VALID_STYLES),
                "outlier_columns": list(OUTLIER_COLUMNS), "output_file": "cleaned_ALL_OH_365d"}
CLEAN_TAGS = {"pipeline_stage": "data_cleaning"}


def _run_log(spark, sf):
    lst = listings(spark, sf)
    steps, log = C.clean_observed(lst)
    bounds = io.outlier_metrics(C.outlier_report(steps["style_filtered"]), OUTLIER_COLUMNS)
    clean = io.run_log_rows("clean", "run-clean", log.crossJoin(F.broadcast(bounds)), CLEAN_PARAMS, CLEAN_TAGS, TS1)
    summ = Q.summarize_suite(Q.evaluate_suite(steps["cleaned"])).select(
        "evaluated", "passed", "failed", F.col("success").cast("int").alias("success"))
    val = io.run_log_rows("validate", "run-validate", summ, ts=TS1)
    return clean.unionByName(val)


def _stored_log(spark, sf):
    """The run log written twice (a rerun adds nothing) and read back."""
    path = scratch_path(spark, "run_log")
    rows = _run_log(spark, sf)
    for _ in range(2):
        io.append_run_log(rows, path)
    return io.read_run_log(spark, path)


def _run_log_sql():
    metrics = ["raw_rows", "raw_columns", "empty_rows_dropped", "duplicates_dropped", "missing_target_dropped",
               "style_filter_dropped", "outliers_dropped", "cleaned_rows", "total_rows_removed", "removal_pct"]
    base = _cleaning_log_sql()
    head, body = base.rsplit("\nSELECT", 1)
    from homeledger.plans.q_quality import suite_sql
    c2, b2 = suite_sql("cleaned")
    head_cols = f"'run-clean' AS run_id, 'clean' AS stage, '{TS1}' AS ts"
    unp = " UNION ALL ".join(
        f"SELECT {head_cols}, 'metric' AS kind, '{m}' AS key, CAST({m} AS DOUBLE) AS value, "
        f"CAST(NULL AS VARCHAR) AS text FROM cl" for m in metrics)
    lo, hi = (f"({{c}}__q{q} {sign} 1.5 * ({{c}}__q3 - {{c}}__q1))" for q, sign in ((1, "-"), (3, "+")))
    out = " UNION ALL ".join(
        f"SELECT {head_cols}, 'metric', 'outlier_{c}_{name}', CAST({e.format(c=c)} AS DOUBLE), NULL FROM cleaned_qb"
        for c in OUTLIER_COLUMNS for name, e in (
            ("count", f"(SELECT count(*) FROM s4 WHERE TRY_CAST({c} AS DOUBLE) < {lo} OR TRY_CAST({c} AS DOUBLE) > {hi})"),
            ("lower", f"round({lo}, 2)"), ("upper", f"round({hi}, 2)")))
    quoted = lambda v: "'" + (", ".join(v) if isinstance(v, list) else v) + "'"
    par = " UNION ALL ".join(
        f"SELECT {head_cols}, '{kind}', '{k}', {v if isinstance(v, float) else 'NULL'}, "
        f"{'NULL' if isinstance(v, float) else quoted(v)}"
        for kind, own in (("param", CLEAN_PARAMS), ("tag", CLEAN_TAGS)) for k, v in own.items())
    val = " UNION ALL ".join(
        f"SELECT 'run-validate', 'validate', '{TS1}', 'metric', '{m}', CAST({e} AS DOUBLE), NULL FROM vs"
        for m, e in [("evaluated", "count(*)"), ("passed", "count(*) FILTER (WHERE success)"),
                     ("failed", "count(*) FILTER (WHERE NOT success)"),
                     ("success", "CASE WHEN count(*) FILTER (WHERE NOT success) = 0 THEN 1 ELSE 0 END")])
    return (head + f",\ncl AS (SELECT{body}),\n{c2},\nvs AS ({b2})\n",
            " UNION ALL ".join([unp, out, par, val]))


@register("append_run_log", lambda: "".join(_run_log_sql()))
def q_append_run_log(spark, sf):
    return _stored_log(spark, sf)


@register("run_summary", lambda: _run_log_sql()[0] +
          "SELECT section, position, key, value, text FROM (SELECT CASE kind WHEN 'metric' THEN 'metric' ELSE 'param' END "
          "AS section, CASE WHEN kind = 'param' THEN 0 ELSE " + "CASE key " +
          " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(CLEAN_METRICS)) + " END END AS position, key, value, text, kind "
          f"FROM ({_run_log_sql()[1]})) WHERE (kind = 'metric' AND position IS NOT NULL) OR "
          f"(kind = 'param' AND key NOT IN ({', '.join(repr(s) for s in SKIP_PARAMS)}))")
def q_run_summary(spark, sf):
    return io.run_summary(_stored_log(spark, sf), CLEAN_METRICS, SKIP_PARAMS)


@register("write_report")
def q_write_report(spark, sf):
    """#8: the cleaning log and suite summary written as one JSON report row, read back."""
    lst = listings(spark, sf)
    steps, log = C.clean_observed(lst)
    summ = Q.summarize_suite(Q.evaluate_suite(steps["cleaned"]))
    row = log.crossJoin(summ).select(F.struct(*log.columns).alias("cleaning_log"),
                                     F.struct(*summ.columns).alias("validation"),
                                     F.lit(TS1).alias("timestamp"))
    path = scratch_path(spark, "report")
    for _ in range(2):  # a rerun adds nothing
        io.write_reports(row, path, "run-clean")
    return io.read_reports(spark, path, row.schema)
