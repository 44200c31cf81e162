"""Queries for the quarantine review trail (40-44).

Snapshots: the raw listings of each county (``<COUNTY>_OH_365d_<ts>``) are
validated at TS1 (they fail and are quarantined); the cleaned listings of each
county are validated at TS2 (they pass).  Reviews: every quarantined snapshot
is first rejected, then the ones outside the 'A…' regions are approved.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger.operators import clean as C
from homeledger.operators import review as RV
from homeledger.plans.q_quality import fingerprint_sql, suite_sql
from homeledger.plans.registry import register
from homeledger.plans.sqlbits import with_cleaned
from homeledger.schema import LISTING_COLUMNS
from homeledger.session import materialize, scratch_path
from homeledger.sources.fixture import listings
from homeledger.sources.io import snapshot_label

STAMP = "20250414_183022"
TS1, TS2, TS3, TS4 = "2025-04-14T18:31:00", "2025-04-15T09:00:00", "2025-04-16T10:00:00", "2025-04-17T11:00:00"
FIX_RULES = ["beds>8", "style==MULTI_FAMILY"]


def _label(df):
    return df.withColumn("snapshot", snapshot_label(F.concat(F.col("county"), F.lit(", OH")), F.lit(365), F.lit(STAMP)))


def _reports(spark, sf):
    raw = _label(listings(spark, sf))
    cleaned = _label(C.clean_data(listings(spark, sf)))
    return raw, RV.validation_reports(raw, TS1), RV.validation_reports(cleaned, TS2)


def _reviews(run1):
    q = run1.where(~F.col("success")).select(
        F.regexp_extract("data_path", r"([^/]+)\.csv$", 1).alias("quarantined_snapshot"))
    first = q.select("quarantined_snapshot", F.lit(False).alias("approve"), F.lit("").alias("reason"),
                     F.lit("analyst").alias("reviewer"), F.lit(TS3).alias("review_timestamp"))
    second = q.where(~F.col("quarantined_snapshot").startswith("quarantined_A")).select(
        "quarantined_snapshot", F.lit(True).alias("approve"), F.lit("outliers checked by hand").alias("reason"),
        F.lit("").alias("reviewer"), F.lit(TS4).alias("review_timestamp"))
    return first.unionByName(second)


# ------------------------------------------------------------------ SQL twin
LABEL_SQL = f"replace(replace(trim(county || ', OH'), ',', ''), ' ', '_') || '_365d_{STAMP}'"


def _report_ctes():
    c1, b1 = suite_sql("rawsnap", by="snapshot")
    c2, b2 = suite_sql("cleansnap", by="snapshot")
    fx, bx = suite_sql("fixsnap", by="snapshot")

    def rep(name, body, src, ts):
        return (f"{name}_res AS ({body}), {name} AS (SELECT s.snapshot, s.success, s.evaluated, s.passed, s.failed, "
                f"'{ts}' AS timestamp, f.row_count, f.fingerprint AS dataset_hash, 'data/' || CASE WHEN s.success THEN "
                f"'processed/validated_' ELSE 'errors/quarantined_' END || s.snapshot || '.csv' AS data_path, "
                f"COALESCE(e.names, '') AS failed_expectations FROM (SELECT snapshot, CAST(count(*) AS INTEGER) "
                f"AS evaluated, CAST(count(*) FILTER (WHERE success) AS INTEGER) AS passed, CAST(count(*) FILTER "
                f"(WHERE NOT success) AS INTEGER) AS failed, count(*) FILTER (WHERE NOT success) = 0 AS success "
                f"FROM {name}_res GROUP BY snapshot) s JOIN ({fingerprint_sql(src, by='snapshot')}) f USING (snapshot) "
                f"LEFT JOIN (SELECT snapshot, string_agg(expectation, ', ' ORDER BY ordinal) AS names FROM {name}_res "
                f"WHERE NOT success GROUP BY snapshot) e USING (snapshot))")
    from homeledger.plans.q_features import _rule_sql
    fix_pred = " OR ".join(_rule_sql(r) for r in FIX_RULES)
    cols = ", ".join(LISTING_COLUMNS)
    return [
        f"rawsnap AS (SELECT {cols}, {LABEL_SQL} AS snapshot FROM listings)",
        f"cleansnap AS (SELECT {cols}, {LABEL_SQL} AS snapshot FROM cleaned)",
        c1, c2, rep("run1", b1, "rawsnap", TS1), rep("run2", b2, "cleansnap", TS2),
        "quar AS (SELECT regexp_extract(data_path, '([^/]+)\\.csv$', 1) AS quarantined_snapshot, snapshot "
        "FROM run1 WHERE NOT success)",
        f"fixsnap AS (SELECT * FROM rawsnap WHERE snapshot IN (SELECT snapshot FROM quar) AND NOT ({fix_pred}))",
        fx, rep("fixrep", bx, "fixsnap", TS2),
        f"reviews AS (SELECT quarantined_snapshot, FALSE AS approve, '' AS reason, 'analyst' AS reviewer, "
        f"'{TS3}' AS review_timestamp FROM quar UNION ALL SELECT quarantined_snapshot, TRUE, 'outliers checked by hand', "
        f"'', '{TS4}' FROM quar WHERE NOT starts_with(quarantined_snapshot, 'quarantined_A'))",
        "decisions AS (SELECT quarantined_snapshot, CASE WHEN approve THEN 'approved' ELSE 'rejected' END AS decision, "
        "COALESCE(NULLIF(reason, ''), 'Manual ' || CASE WHEN approve THEN 'approved' ELSE 'rejected' END || "
        "' — no reason provided') AS reason, COALESCE(NULLIF(reviewer, ''), 'unknown') AS reviewer, "
        "CASE WHEN approve THEN 'data/processed/approved_' ELSE 'data/archive/rejected_' END || quarantined_snapshot "
        "|| '.csv' AS destination_file, review_timestamp FROM (SELECT *, row_number() OVER (PARTITION BY "
        "quarantined_snapshot ORDER BY review_timestamp DESC) AS r FROM reviews) WHERE r = 1)",
    ]


def _sql(body):
    return lambda: with_cleaned(*_report_ctes()) + body


@register("list_quarantined", _sql(
    "SELECT DISTINCT ON (snapshot) regexp_extract(data_path, '([^/]+)\\.csv$', 1) AS quarantined_snapshot, snapshot, "
    "failed, failed_expectations FROM (SELECT * FROM run1 UNION ALL SELECT * FROM run2) WHERE NOT success "
    "ORDER BY snapshot, timestamp DESC, data_path DESC"))
def q_list_quarantined(spark, sf):
    _, run1, run2 = _reports(spark, sf)
    return RV.list_quarantined(run1.unionByName(run2))


@register("match_report", _sql(
    "SELECT regexp_extract(data_path, '([^/]+)\\.csv$', 1) AS report_file, snapshot, timestamp, success, failed, "
    "row_count, dataset_hash FROM (SELECT *, row_number() OVER (PARTITION BY snapshot ORDER BY timestamp DESC, "
    "data_path DESC) AS r FROM (SELECT * FROM run1 UNION ALL SELECT * FROM run2)) WHERE r = 1"))
def q_match_report(spark, sf):
    _, run1, run2 = _reports(spark, sf)
    m = RV.match_report(run1.unionByName(run2))
    return m.select(F.regexp_extract("data_path", r"([^/]+)\.csv$", 1).alias("report_file"), "snapshot",
                    "timestamp", "success", "failed", "row_count", "dataset_hash")


@register("review_decision", _sql("SELECT * FROM decisions"))
def q_review_decision(spark, sf):
    _, run1, _ = _reports(spark, sf)
    return RV.review_decisions(_reviews(run1))


@register("fix_and_approve", _sql(
    "SELECT b.snapshot, b.rows_before, COALESCE(a.rows_after, 0) AS rows_after, b.rows_before - COALESCE(a.rows_after, 0) "
    "AS rows_removed, CASE WHEN COALESCE(a.rows_after, 0) = 0 THEN 'refused_empty' ELSE 'approved' END AS status, "
    "f.success AS revalidation_success, f.passed AS revalidation_passed, f.failed AS revalidation_failed, "
    "f.dataset_hash AS fixed_hash, CASE WHEN COALESCE(a.rows_after, 0) > 0 THEN 'data/processed/fixed_' || b.snapshot "
    "|| '.csv' END AS fixed_file, CASE WHEN b.rows_before > COALESCE(a.rows_after, 0) THEN 'data/archive/removed_' "
    "|| b.snapshot || '.csv' END AS removed_file FROM (SELECT snapshot, count(*) AS rows_before FROM rawsnap WHERE "
    "snapshot IN (SELECT snapshot FROM quar) GROUP BY snapshot) b LEFT JOIN (SELECT snapshot, count(*) AS rows_after "
    "FROM fixsnap GROUP BY snapshot) a USING (snapshot) LEFT JOIN fixrep f USING (snapshot)"))
def q_fix_and_approve(spark, sf):
    raw, run1, _ = _reports(spark, sf)
    quar = run1.where(~F.col("success")).select("snapshot")
    snapshots = raw.join(quar, "snapshot", "left_semi")
    path = RV.write_fixed(snapshots, FIX_RULES, scratch_path(spark, "fixed"))
    # the counts of the report are those of the files, read back
    files = RV.read_files(spark, path).groupBy("snapshot").agg(
        F.count_if(F.col("stage") == "processed").alias("rows_after"),
        F.count_if(F.col("stage") == "archive").alias("rows_removed"))
    report = RV.fix_and_approve(snapshots, FIX_RULES, TS2)
    return report.drop("rows_after", "rows_removed").join(files, "snapshot").select(*report.columns)


@register("review_moves", _sql(
    "SELECT d.destination_file, d.decision, o.failed AS original_failed, count(*) AS rows FROM decisions d JOIN rawsnap s "
    "ON s.snapshot = substr(d.quarantined_snapshot, 13) JOIN (SELECT DISTINCT ON (snapshot) snapshot, failed FROM "
    "(SELECT * FROM run1 UNION ALL SELECT * FROM run2) WHERE NOT success ORDER BY snapshot, timestamp DESC, data_path DESC) o "
    "ON o.snapshot = s.snapshot GROUP BY ALL"))
def q_review_moves(spark, sf):
    """#42: the rows that approving and rejecting moved, read back from their destinations."""
    raw, run1, run2 = _reports(spark, sf)
    decisions = materialize(RV.review_decisions(_reviews(run1)), "decisions")
    path = scratch_path(spark, "reviewed")
    for _ in range(2):  # a rerun adds nothing
        RV.apply_decisions(raw, decisions, path)
    moved = RV.read_files(spark, path).groupBy("stage", "file").agg(F.count(F.lit(1)).alias("rows")).select(
        F.concat(F.lit("data/"), "stage", F.lit("/"), "file", F.lit(".csv")).alias("destination_file"), "rows")
    return RV.review_reports(decisions, run1.unionByName(run2)).join(moved, "destination_file").select(
        "destination_file", "decision", F.col("original_validation.failed").alias("original_failed"), "rows")


@register("review_audit", _sql(
    "SELECT d.quarantined_snapshot, d.decision, d.reviewer, o.failed AS original_failed, x.failed AS "
    "revalidation_failed, CASE WHEN d.decision = 'approved' THEN COALESCE(x.failed_expectations, '') ELSE '' END "
    "AS accepted_failures FROM decisions d LEFT JOIN run1 o ON o.snapshot = substr(d.quarantined_snapshot, 13) "
    "LEFT JOIN fixrep x ON x.snapshot = substr(d.quarantined_snapshot, 13)"))
def q_review_audit(spark, sf):
    raw, run1, _ = _reports(spark, sf)
    quar = run1.where(~F.col("success")).select("snapshot")
    kept, _ = __import__("homeledger.operators.rules", fromlist=["x"]).apply_filter_rules(
        raw.join(quar, "snapshot", "left_semi"), FIX_RULES)
    revalidated = RV.validation_reports(kept, TS2)
    return RV.review_audit(RV.review_decisions(_reviews(run1)), run1, revalidated)
