"""Quarantine review trail as tables (#40-#44).

Snapshots are a column, not files: one validation job grouped by snapshot
produces the report table; reviews are an append-only event table and the
current decision is the latest event per snapshot.  Reports are matched to
snapshots by the snapshot name extracted from their data path (an equi-join,
not a substring scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homeledger.operators import quality as Q
from homeledger.operators.rules import apply_filter_rules, split_column
from homeledger.session import materialize
from homeledger.sources import commits
from homeledger.sources.io import stage_name, strip_known_prefix


def validation_reports(df: DataFrame, ts: str, by: str = "snapshot") -> DataFrame:
    """Written table, one report row per snapshot (F6): verdict, counts, fingerprint, data path, failures.

    Reports are read more than once and joined to the rows they are about: as a
    table their size is known, so such a join never deals the rows by snapshot.
    """
    # one row per snapshot and expectation: written once, so the summary and the failures share one scan
    res = materialize(Q.evaluate_suite(df, by=[by]), "suite")
    summ = Q.summarize_suite(res, [by])
    fails = (res.where(~F.col("success")).groupBy(by)
             .agg(F.array_sort(F.collect_list(F.struct("ordinal", "expectation", "kwargs",
                                                        F.col("observed").cast("string").alias("observed"))))
                  .alias("__f")))
    fp = Q.dataset_fingerprint(df, [by])
    routed = summ.join(fp, by).join(fails, by, "left")
    target = F.when(F.col("success"), stage_name("validated", F.col(by))).otherwise(stage_name("quarantined", F.col(by)))
    route = F.when(F.col("success"), F.lit("processed")).otherwise(F.lit("errors"))
    return materialize(routed.select(
        by, "success", "evaluated", "passed", "failed", F.lit(ts).alias("timestamp"), "row_count",
        F.lit(len(df.columns) - 1).alias("column_count"), F.col("fingerprint").alias("dataset_hash"),
        F.concat(F.lit("data/"), route, F.lit("/"), target, F.lit(".csv")).alias("data_path"),
        F.coalesce(F.transform("__f", lambda s: s.dropFields("ordinal")),
                   F.array().cast("array<struct<expectation:string,kwargs:string,observed:string>>")).alias("failures")),
        "reports")


def report_snapshot(data_path) -> "F.Column":
    """Base snapshot name of a report's data path (file stem without its verb prefix)."""
    return strip_known_prefix(F.regexp_extract(data_path, r"([^/]+)\.csv$", 1))


def list_quarantined(reports: DataFrame) -> DataFrame:
    """#40: quarantined snapshots with the failures of their newest failing report (joined on
    snapshot name); a later report that passes does not hide them."""
    q = reports.where(~F.col("success")).select(
        F.regexp_extract("data_path", r"([^/]+)\.csv$", 1).alias("quarantined_snapshot"),
        report_snapshot(F.col("data_path")).alias("snapshot")).distinct()
    latest = match_report(reports.where(~F.col("success")))
    return q.join(latest, "snapshot", "left").select(
        "quarantined_snapshot", "snapshot", "failed",
        F.array_join(F.transform("failures", lambda f: f["expectation"]), ", ").alias("failed_expectations"))


def match_report(reports: DataFrame) -> DataFrame:
    """#41: newest report per snapshot name (ties: the later data path)."""
    r = reports.withColumn("snapshot", report_snapshot(F.col("data_path")))
    w = Window.partitionBy("snapshot").orderBy(F.desc("timestamp"), F.desc("data_path"))
    return r.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def review_decisions(reviews: DataFrame) -> DataFrame:
    """#42: the latest decision per quarantined snapshot (equal times: a rejection, then the later reviewer
    and reason by name, so any order of the events gives the same); approve -> processed/approved_<file>,
    reject -> archive/rejected_<file>; default reason and reviewer filled in."""
    w = Window.partitionBy("quarantined_snapshot").orderBy(
        F.desc("review_timestamp"), "approve", F.desc("reviewer"), F.desc("reason"))
    last = reviews.withColumn("__r", F.row_number().over(w)).where("__r = 1")
    decision = F.when(F.col("approve"), "approved").otherwise("rejected")
    return last.select(
        "quarantined_snapshot", decision.alias("decision"),
        F.coalesce(F.nullif(F.col("reason"), F.lit("")),
                   F.concat(F.lit("Manual "), decision, F.lit(" — no reason provided"))).alias("reason"),
        F.coalesce(F.nullif(F.col("reviewer"), F.lit("")), F.lit("unknown")).alias("reviewer"),
        F.when(F.col("approve"), F.concat(F.lit("data/processed/approved_"), F.col("quarantined_snapshot"), F.lit(".csv")))
         .otherwise(F.concat(F.lit("data/archive/rejected_"), F.col("quarantined_snapshot"), F.lit(".csv")))
         .alias("destination_file"),
        "review_timestamp")


def fix_and_approve(snapshots: DataFrame, rules: list[str], ts: str, by: str = "snapshot") -> DataFrame:
    """#43: per quarantined snapshot — filter rows by rules, refuse an empty result,
    re-validate the rest, name the fixed/removed sets; approved even when the
    re-validation still fails.  Returns one report row per snapshot."""
    kept, _ = apply_filter_rules(snapshots, rules)
    counts = split_column(snapshots, rules).groupBy(by).agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(F.col("split") == "kept").alias("rows_after"))
    reval = validation_reports(kept, ts, by).select(
        by, F.col("success").alias("revalidation_success"), F.col("passed").alias("revalidation_passed"),
        F.col("failed").alias("revalidation_failed"), F.col("dataset_hash").alias("fixed_hash"))
    rows_after = F.col("rows_after")
    empty = rows_after == 0
    return counts.join(reval, by, "left").select(
        by, "rows_before", "rows_after", (F.col("rows_before") - rows_after).alias("rows_removed"),
        F.when(empty, "refused_empty").otherwise("approved").alias("status"),
        "revalidation_success", "revalidation_passed", "revalidation_failed", "fixed_hash",
        F.when(~empty, F.concat(F.lit("data/processed/"), stage_name("fixed", F.col(by)), F.lit(".csv")))
         .alias("fixed_file"),
        F.when(F.col("rows_before") > rows_after, F.concat(F.lit("data/archive/"), stage_name("removed", F.col(by)),
                                                           F.lit(".csv"))).alias("removed_file"))


#: The unit of a store of reviewed rows.
FILE_KEYS = ["stage", "file"]


def read_files(spark: SparkSession, base_path: str) -> DataFrame:
    """The rows that reviews moved, with the stage and file they went to."""
    return commits.read(spark, base_path, FILE_KEYS)


def write_fixed(snapshots: DataFrame, rules: list[str], base_path: str, by: str = "snapshot",
                version: str | None = None) -> str:
    """#43: one pass over the quarantined rows — the rest of each snapshot to
    processed/fixed_…, the rows that a rule removes to archive/removed_….  Both
    become visible together; a rerun replaces the files it writes."""
    removed = F.col("split") == "removed"
    commits.publish(split_column(snapshots, rules).select(
        "*", F.when(removed, "archive").otherwise("processed").alias("stage"),
        F.when(removed, stage_name("removed", F.col(by))).otherwise(stage_name("fixed", F.col(by))).alias("file"))
        .drop("split"), base_path, FILE_KEYS, version, step="fix and approve")
    return base_path


def apply_decisions(snapshots: DataFrame, decisions: DataFrame, base_path: str, by: str = "snapshot",
                    version: str | None = None) -> str:
    """#42: rows of decided snapshots to the decision's destination (processed/approved_… or
    archive/rejected_…); undecided ones stay in quarantine.  All moves become visible
    together; a rerun replaces the files it writes."""
    # one row per decided snapshot, written: a join of known size keeps the rows where they are
    to = materialize(decisions.select(strip_known_prefix(F.col("quarantined_snapshot")).alias(by),
                          F.regexp_extract("destination_file", r"data/([^/]+)/", 1).alias("stage"),
                          F.regexp_extract("destination_file", r"([^/]+)\.csv$", 1).alias("file")), "decisions")
    commits.publish(snapshots.join(to, by), base_path, FILE_KEYS, version, step="review")
    return base_path


def review_reports(decisions: DataFrame, reports: DataFrame) -> DataFrame:
    """#42: decisions with the newest failing report of their snapshot as ``original_validation``."""
    own = match_report(reports.where(~F.col("success"))).select("snapshot", F.struct(
        "timestamp", "evaluated", "passed", "failed", "failures", "dataset_hash", "row_count").alias("original_validation"))
    return (decisions.withColumn("snapshot", strip_known_prefix(F.col("quarantined_snapshot")))
            .join(own, "snapshot", "left").drop("snapshot"))


def review_audit(decisions: DataFrame, original: DataFrame, revalidated: DataFrame) -> DataFrame:
    """#44: per decision — failures in the original report, failures still present when
    approved (accepted by hand), and the re-validation count."""
    o = original.select(report_snapshot(F.col("data_path")).alias("snapshot"),
                        F.col("failed").alias("original_failed"))
    r = revalidated.select(report_snapshot(F.col("data_path")).alias("snapshot"),
                           F.col("failed").alias("revalidation_failed"),
                           F.array_join(F.transform("failures", lambda f: f["expectation"]), ", ").alias("__acc"))
    d = decisions.withColumn("snapshot", strip_known_prefix(F.col("quarantined_snapshot")))
    return d.join(o, "snapshot", "left").join(r, "snapshot", "left").select(
        "quarantined_snapshot", "decision", "reviewer", "original_failed", "revalidation_failed",
        F.when(F.col("decision") == "approved", F.coalesce("__acc", F.lit(""))).otherwise(F.lit(""))
         .alias("accepted_failures"))
