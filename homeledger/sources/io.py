"""Sources and sinks: listing files, snapshots, reports, run log, predictions.

Files are snapshots; lineage lives in the snapshot name (``<verb>_<label>``).
Instead of picking files by name or time, all stages of a base folder are one
store with a commit log (:mod:`homeledger.sources.commits`), keyed by stage and
snapshot: readers see what was published, and prune the rest.  Reports and the
run log are stores of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeledger.functions.columns import nan_to_null
from homeledger.schema import KNOWN_PREFIXES, LISTING_SCHEMA
from homeledger.session import scratch_path
from homeledger.sources import commits

#: The unit of a stage store.
SNAPSHOT_KEYS = ["stage", "snapshot"]

_MATERIALIZED: dict[tuple[str, str], str] = {}


def read_listings(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType = LISTING_SCHEMA) -> DataFrame:
    """#1: read a listing file with a declared schema (no inference pass).

    CSV needs ``header``; the schema fixes zip codes as text.  Parquet keeps
    predicate pushdown and column pruning.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return nan_to_null(reader.option("header", True).option("mode", "PERMISSIVE").csv(path))
    return nan_to_null(reader.format(fmt).load(path))


def materialize_listings_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the listings view once as a CSV snapshot (under the checkpoint dir)."""
    from homeledger.sources.fixture import listings

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MATERIALIZED:
        path = scratch_path(spark, "listings-csv")
        listings(spark, sf_dir).write.mode("errorifexists").option("header", True).csv(path)
        _MATERIALIZED[key] = path
    return _MATERIALIZED[key]


def materialize_listings_parquet(spark: SparkSession, sf_dir: str) -> str:
    """Write the listings view once as a Parquet table (the stored listing table)."""
    from homeledger.sources.fixture import listings

    key = (spark.sparkContext.applicationId, sf_dir, "parquet")
    if key not in _MATERIALIZED:
        path = scratch_path(spark, "listings-parquet")
        listings(spark, sf_dir).write.mode("errorifexists").parquet(path)
        _MATERIALIZED[key] = path
    return _MATERIALIZED[key]


def strip_known_prefix(name):
    """Remove ONE leading verb prefix (validated_, quarantined_, …) from a snapshot name."""
    expr = F.when(F.lit(False), name)
    for p in KNOWN_PREFIXES:
        expr = expr.when(name.startswith(p), F.substring(name, len(p) + 1, 1 << 20))
    return expr.otherwise(name)


def snapshot_label(location, past_days, ts_text):
    """``'Cincinnati, OH'``, 365, ``'20250414_183022'`` -> ``Cincinnati_OH_365d_20250414_183022``."""
    loc = F.translate(F.regexp_replace(F.trim(location), ",", ""), " ", "_")
    return F.concat(loc, F.lit("_"), past_days.cast("string"), F.lit("d_"), ts_text)


def stage_name(verb: str, source_name):
    """``<verb>_<source without its verb prefix>`` — the next stage's snapshot name."""
    return F.concat(F.lit(verb + "_"), strip_known_prefix(source_name))


def route_verdict(verdicts: DataFrame, source_name) -> DataFrame:
    """#7: pass -> processed (``validated_``), fail -> errors (``quarantined_``)."""
    return verdicts.select(
        "*",
        F.when(F.col("success"), F.lit("processed")).otherwise(F.lit("errors")).alias("route"),
        F.when(F.col("success"), stage_name("validated", source_name))
         .otherwise(stage_name("quarantined", source_name)).alias("target_snapshot"))


def route_snapshot(df: DataFrame, verdict_success: bool, base_path: str, source_name: str,
                   strict: bool = False, version: str | None = None) -> dict[str, str]:
    """#7: publish the snapshot to processed or errors; returns its stage and name there.

    ``verdict_success`` is the suite verdict (45 rows reduced on the driver).
    ``strict`` raises instead of quarantining.  ``version`` as in ``write_snapshot``.
    """
    if not verdict_success and strict:
        raise ValueError(f"validation failed for {source_name}; strict mode refuses to quarantine")
    verb, stage = ("validated", "processed") if verdict_success else ("quarantined", "errors")
    name = f"{verb}_{_strip_prefix_py(source_name)}"
    write_snapshot(df.withColumn("snapshot", F.lit(name)), base_path, stage, version=version)
    return {"stage": stage, "snapshot": name}


def _strip_prefix_py(name: str) -> str:
    for p in KNOWN_PREFIXES:
        if name.startswith(p):
            return name[len(p):]
    return name


def pull_listings(df: DataFrame, location: str, listing_type: str, past_days: int, as_of: str) -> DataFrame:
    """#3: listings of one location ('City, ST'), listing type and the last N days up to ``as_of``.

    Predicates stay on stored columns so they reach the Parquet scan.
    """
    city, _, state = (p.strip() for p in location.partition(","))
    d = F.try_to_date(F.col("list_date"))
    cond = (F.col("city") == city) & (F.col("status") == listing_type.upper()) & \
           (d >= F.date_sub(F.to_date(F.lit(as_of)), past_days)) & (d <= F.to_date(F.lit(as_of)))
    if state:
        cond = cond & (F.col("state") == state)
    return df.where(cond)


def write_snapshot(df: DataFrame, base_path: str, stage: str, version: str | None = None) -> str:
    """#6: publish a table with a ``snapshot`` column to a stage.

    Readers see the rows once all are written.  A rerun replaces the snapshots it
    writes and leaves the others, and one under a ``version`` that is published
    already adds nothing, so no row is ever doubled.
    """
    commits.publish(df.withColumn("stage", F.lit(stage)), base_path, SNAPSHOT_KEYS, version, step=f"write {stage}")
    return base_path


def read_snapshots(spark: SparkSession, base_path: str, stage: str) -> DataFrame:
    """Rows of all published snapshots of a stage."""
    return commits.read(spark, base_path, SNAPSHOT_KEYS).where(F.col("stage") == stage).drop("stage")


def latest_snapshot(spark: SparkSession, base_path: str, stage: str) -> DataFrame:
    """#2: rows of the snapshot of a stage that was published last (of one publication: the last
    name); only its folder is read, and a stage without one raises."""
    unit = commits.newest_unit(spark, base_path, SNAPSHOT_KEYS, stage=stage)
    return commits.read_unit(spark, base_path, unit).drop("stage")


def write_reports(reports: DataFrame, path: str, run_id: str) -> str:
    """#8: publish the reports of a run as JSON lines (one object per report); a repeated run replaces its own."""
    commits.publish(reports.withColumn("run_id", F.lit(run_id)), path, ["run_id"], step="reports", fmt="json")
    return path


def read_reports(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """#9: the published reports of all runs with a declared schema (a field the reports lack is
    null); broken records are skipped."""
    keyed = schema if "run_id" in schema.names else T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    return commits.read(spark, path, ["run_id"], schema=keyed).select(*schema.names)


def run_log_rows(stage: str, run_id: str, metrics: DataFrame, params: dict | None = None,
                 tags: dict[str, str] | None = None, ts: str | None = None) -> DataFrame:
    """#10: one-row metric table -> long (run_id, stage, ts, kind, key, value, text) rows.

    Numbers go to ``value``; text parameters and tags go to ``text``, lists
    joined by ", ".  ``ts`` is the run's time.
    """
    num_cols = [c for c, t in metrics.dtypes if t in ("int", "bigint", "double", "float", "smallint")]
    long = metrics.select(F.inline(F.array(*[
        F.struct(F.lit("metric").alias("kind"), F.lit(c).alias("key"), F.col(c).cast("double").alias("value"),
                 F.lit(None).cast("string").alias("text")) for c in num_cols])))
    number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
    text = lambda v: ", ".join(map(str, v)) if isinstance(v, (list, tuple)) else str(v)
    extra = [("param", k, float(v), None) if number(v) else ("param", k, None, text(v)) for k, v in (params or {}).items()]
    extra += [("tag", k, None, str(v)) for k, v in (tags or {}).items()]
    spark = metrics.sparkSession
    if extra:
        long = long.unionByName(spark.createDataFrame(extra, "kind string, key string, value double, text string"))
    return long.select(F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), F.lit(ts).cast("string").alias("ts"),
                       "kind", "key", "value", "text")


def outlier_metrics(report: DataFrame, columns: list[str]) -> DataFrame:
    """#10: the outlier report as one row: outlier_<column>_count, _lower and _upper."""
    return report.groupBy().agg(*[
        F.max(F.when(F.col("column") == c, F.col(source).cast("double"))).alias(f"outlier_{c}_{name}")
        for c in columns for name, source in (("count", "outliers_found"), ("lower", "lower_bound"), ("upper", "upper_bound"))])


def append_run_log(rows: DataFrame, path: str) -> None:
    """#10: publish runs to the run log table, keyed by stage and run; a repeated run replaces its own rows."""
    commits.publish(rows, path, ["stage", "run_id"], step="run log")


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """The published run log, columns as written."""
    return commits.read(spark, path, ["stage", "run_id"]).select("run_id", "stage", "ts", "kind", "key", "value", "text")


def run_summary(log: DataFrame, metric_order: list[str], skip_params: list[str]) -> DataFrame:
    """#64: metrics in display order, then parameters (numbers or text) minus a skip list."""
    order = F.create_map(*[x for i, k in enumerate(metric_order) for x in (F.lit(k), F.lit(i))])
    m = log.where((F.col("kind") == "metric") & order[F.col("key")].isNotNull()).select(
        F.lit("metric").alias("section"), order[F.col("key")].alias("position"), "key", "value", "text")
    p = log.where((F.col("kind") == "param") & ~F.col("key").isin(skip_params)).select(
        F.lit("param").alias("section"), F.lit(0).alias("position"), "key", "value", "text")
    return m.unionByName(p)
