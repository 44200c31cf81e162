"""Reviews at size: rows are joined to reports and units without being dealt by snapshot."""

from pyspark.sql import functions as F

from homeledger.functions.columns import digest_sum
from homeledger.operators import review as RV
from homeledger.session import scratch_path
from homeledger.sources.fixture import listings


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _snapshots(spark):
    return listings(spark, "/root/testdata/sf0.001").withColumn("snapshot", F.concat(F.lit("s_"), F.col("county")))


def test_f10_f20_reports_are_a_written_table(spark):
    rows = _snapshots(spark)
    reports = RV.validation_reports(rows, "t")
    assert len(reports.inputFiles()) and "Aggregate" not in _plan(reports)
    assert "SortMergeJoin" not in _plan(rows.join(reports.where("NOT success").select("snapshot"), "snapshot", "left_semi"))


def test_f11_moved_rows_are_read_without_a_shuffle(spark):
    rows = _snapshots(spark)
    decisions = rows.select(F.concat(F.lit("quarantined_"), "snapshot").alias("quarantined_snapshot")).distinct().select(
        "quarantined_snapshot", F.concat(F.lit("data/processed/approved_"), "quarantined_snapshot", F.lit(".csv")).alias("destination_file"))
    moved = RV.read_files(spark, RV.apply_decisions(rows, decisions, scratch_path(spark, "moved")))
    plan = _plan(moved)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert moved.count() == rows.count()


def test_f10_counts_of_a_snapshot_that_the_rules_empty(spark):
    rows = _snapshots(spark).where("beds IS NOT NULL").withColumn(
        "beds", F.when(F.col("county") == "REGION_0", 50).otherwise(F.col("beds")))
    report = {r["snapshot"]: r for r in RV.fix_and_approve(rows, ["beds>20"], "t").collect()}
    want = rows.groupBy("snapshot").agg(F.count("*").alias("n"), F.count_if(F.col("beds") <= 20).alias("kept")).collect()
    assert {k: (r["rows_before"], r["rows_after"]) for k, r in report.items()} == {r["snapshot"]: (r["n"], r["kept"]) for r in want}
    assert {r["status"] for k, r in report.items() if not r["rows_after"]} <= {"refused_empty"}


def test_f21_digest_sum_is_exact_and_adds_no_wide_decimals(spark):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("k"))
    text = F.concat_ws("\u0001", F.col("id").cast("string"), F.col("k").cast("string"))
    plain = F.sum(F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("decimal(38,0)")).cast("decimal(38,0)")
    row = df.agg(digest_sum(["id", "k"]).cast("decimal(38,0)").alias("a"), plain.alias("b")).first()
    assert row["a"] == row["b"] > 2 ** 60
    assert df.where("false").agg(digest_sum(["id"]).alias("a")).first()["a"] is None
