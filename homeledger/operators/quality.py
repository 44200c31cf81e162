"""Data-quality suite and profiling aggregates (#27-#39).

The suite is data: a list of :class:`Expectation`.  :func:`evaluate_suite`
turns ALL of them into ONE aggregate (optionally grouped by snapshot, so any
number of snapshots is validated in one job with map-side partial
aggregation), then unpivots the result to one row per expectation with
``inline``.  Nothing but the tiny result reaches the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeledger.functions.quantiles import exact_quantiles
from homeledger.functions.columns import digest_sum
from homeledger.schema import (
    MIN_ROW_COUNT, NOT_NULL_EXPECTATIONS, RANGE_EXPECTATIONS, REQUIRED_COLUMNS, SET_EXPECTATIONS,
)

ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_COUNT = "expect_table_column_count_to_be_between"
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    value_set: tuple = field(default_factory=tuple)
    mostly: float | None = None

    def kwargs_text(self) -> str:
        kw: dict = {}
        if self.column is not None:
            kw["column"] = self.column
        if self.min_value is not None:
            kw["min_value"] = self.min_value
        if self.max_value is not None:
            kw["max_value"] = self.max_value
        if self.value_set:
            kw["value_set"] = list(self.value_set)
        if self.mostly is not None:
            kw["mostly"] = self.mostly
        return json.dumps(kw, sort_keys=True)


def default_suite() -> list[Expectation]:
    """The 45 expectations for cleaned listings, in suite order."""
    s = [Expectation(ROW_COUNT, min_value=MIN_ROW_COUNT),
         Expectation(COLUMN_COUNT, min_value=len(REQUIRED_COLUMNS))]
    s += [Expectation(EXISTS, c) for c in REQUIRED_COLUMNS]
    s += [Expectation(NOT_NULL, c, mostly=m) for c, m in NOT_NULL_EXPECTATIONS]
    s += [Expectation(BETWEEN, c, lo, hi, mostly=m) for c, lo, hi, m in RANGE_EXPECTATIONS]
    s += [Expectation(IN_SET, c, value_set=tuple(v), mostly=m) for c, v, m in SET_EXPECTATIONS]
    return s


def _share(num: Column, den: Column) -> Column:
    return F.try_divide(num.cast("double"), den.cast("double"))


def _measures(df: DataFrame, e: Expectation, i: int, by: list[str]) -> tuple[list[Column], Column, Column]:
    """(aggregates, observed, success) for expectation ``e`` (aggregates named by ordinal)."""
    has = e.column is not None and e.column in df.columns and e.column not in by
    if e.kind == ROW_COUNT:
        return [], F.col("__rows").cast("double"), F.col("__rows") >= F.lit(e.min_value)
    if e.kind == COLUMN_COUNT:
        n = len(df.columns) - len(by)
        return [], F.lit(float(n)), F.lit(n >= e.min_value)
    if e.kind == EXISTS:
        return [], F.lit(1.0 if has else 0.0), F.lit(has)
    if not has:
        return [], F.lit(None).cast("double"), F.lit(False)
    c = F.col(f"`{e.column}`")
    a, b = f"__a{i}", f"__b{i}"
    if e.kind == NOT_NULL:
        obs = _share(F.col(a), F.col("__rows"))
        return [F.count(c).alias(a)], obs, F.coalesce(obs >= F.lit(e.mostly), F.lit(True))
    if e.kind == BETWEEN:
        ok = F.count_if((c >= F.lit(e.min_value)) & (c <= F.lit(e.max_value)))
    elif e.kind == IN_SET:
        ok = F.count_if(c.isin(list(e.value_set)))
    else:
        raise ValueError(e.kind)
    obs = _share(F.col(a), F.col(b))
    return [ok.alias(a), F.count(c).alias(b)], obs, F.coalesce(obs >= F.lit(e.mostly), F.lit(True))


def evaluate_suite(df: DataFrame, suite: list[Expectation] | None = None,
                   by: list[str] | None = None) -> DataFrame:
    """One row per (group, expectation): ordinal, expectation, column, kwargs, observed, success."""
    suite = suite or default_suite()
    by = by or []
    aggs: list[Column] = [F.count(F.lit(1)).alias("__rows")]
    rows = []
    for i, e in enumerate(suite):
        a, obs, ok = _measures(df, e, i, by)
        aggs += a
        rows.append(F.struct(F.lit(i).alias("ordinal"), F.lit(e.kind).alias("expectation"),
                             F.lit(e.column).cast("string").alias("column"),
                             F.lit(e.kwargs_text()).alias("kwargs"),
                             F.round(obs, 6).alias("observed"), ok.alias("success")))
    agg = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return agg.select(*by, F.inline(F.array(*rows)))


def summarize_suite(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """#30: evaluated, passed, failed, success (per group)."""
    by = by or []
    g = results.groupBy(*by) if by else results.groupBy()
    return g.agg(F.count(F.lit(1)).cast("int").alias("evaluated"),
                 F.count_if("success").cast("int").alias("passed"),
                 F.count_if(~F.col("success")).cast("int").alias("failed"),
                 (F.count_if(~F.col("success")) == 0).alias("success"))


def validation_failures(results: DataFrame) -> DataFrame:
    """#31: failing expectations with kwargs and the observed value."""
    return results.where(~F.col("success"))


def dq_pass_rate(df: DataFrame, results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """#32: passed / max(evaluated, 1) with row and column counts."""
    by = by or []
    s = summarize_suite(results, by)
    rc = (df.groupBy(*by) if by else df.groupBy()).agg(F.count(F.lit(1)).alias("row_count"))
    j = s.crossJoin(rc) if not by else s.join(rc, by)
    return j.select(*by, F.round(F.col("passed") / F.greatest(F.col("evaluated"), F.lit(1)), 4).alias("pass_rate"),
                    "evaluated", "passed", "row_count",
                    F.lit(len(df.columns) - len(by)).alias("column_count"))


def final_null_audit(df: DataFrame) -> DataFrame:
    """#27: columns that still hold nulls, with their counts (one aggregate)."""
    agg = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("null_count")) for c in df.columns])
    return agg.select(F.inline(pairs)).where("null_count > 0")


def schema_snapshot(df: DataFrame) -> DataFrame:
    """#33: per column — type, null count, null % (2 places), plus the table shape."""
    n_cols = len(df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"),
                               F.lit(f.dataType.simpleString()).alias("dtype"),
                               F.col(f"__n{i}").alias("null_count"))
                      for i, f in enumerate(df.schema.fields)])
    return agg.select("__rows", F.inline(pairs)).select(
        "position", "column", "dtype", "null_count",
        F.round(F.try_divide(F.col("null_count") * F.lit(100.0), F.col("__rows").cast("double")), 2).alias("null_pct"),
        F.col("__rows").alias("row_count"), F.lit(n_cols).alias("column_count"))


def dataset_fingerprint(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """#34: order-free content fingerprint: row count + sum of 52-bit row digests (decimal).

    Equal under row reordering and repartitioning; repeated rows still count.
    """
    by = by or []
    cols = [c for c in df.columns if c not in by]
    canon = df.select(*by, *[
        (F.col(f"`{f.name}`").cast("decimal(38,6)") if f.dataType.typeName() in ("double", "float")
         else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields if f.name in cols])
    g = canon.groupBy(*by) if by else canon.groupBy()
    return g.agg(F.count(F.lit(1)).alias("row_count"),
                 digest_sum(cols).cast("decimal(38,0)").cast("string").alias("fingerprint"))


def target_profile(df: DataFrame, target: str = "sold_price") -> DataFrame:
    """#37: target min, max, mean, median (2 places)."""
    c = F.col(target)
    q = exact_quantiles(df, [target], [0.5])
    return df.agg(F.round(F.min(c), 2).alias("min"), F.round(F.max(c), 2).alias("max"),
                  F.round(F.avg(c), 2).alias("mean")).crossJoin(F.broadcast(q)).select(
        "min", "max", "mean", F.round(F.col(f"`__q_{target}`")[0], 2).alias("median"))


def validity_bounds(df: DataFrame, columns: list[str]) -> DataFrame:
    """#38: per numeric feature — min, max, p01, p99, median (2 places): one aggregate
    and the exact quantiles of all columns."""
    aggs = []
    for i, c in enumerate(columns):
        v = F.expr(f"try_cast(`{c}` AS DOUBLE)")
        aggs += [F.min(v).alias(f"__mn{i}"), F.max(v).alias(f"__mx{i}")]
    q = exact_quantiles(df, columns, [0.01, 0.5, 0.99])
    agg = df.agg(*aggs).crossJoin(F.broadcast(
        q.select(*[F.col(f"`__q_{c}`").alias(f"__p{i}") for i, c in enumerate(columns)])))
    rows = F.array(*[F.struct(F.lit(c).alias("feature"),
                              F.round(F.col(f"__mn{i}"), 2).alias("min"),
                              F.round(F.col(f"__mx{i}"), 2).alias("max"),
                              F.round(F.col(f"__p{i}")[0], 2).alias("p01"),
                              F.round(F.col(f"__p{i}")[2], 2).alias("p99"),
                              F.round(F.col(f"__p{i}")[1], 2).alias("median"))
                     for i, c in enumerate(columns)])
    return agg.select(F.inline(rows)).where(F.col("min").isNotNull())


def validity_rules(df: DataFrame) -> DataFrame:
    """#39: newest build year allowed for new construction = max(year_built) - 2."""
    return df.agg((F.max("year_built").cast("int") - 2).alias("new_construction_min_year"))


def feature_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """#36: nulls left after feature engineering, row delta, feature-count delta."""
    n_before = before.agg(F.count(F.lit(1)).alias("__b"))
    agg = after.agg(F.count(F.lit(1)).alias("__a"),
                    sum((F.count_if(F.col(f"`{c}`").isNull()) for c in after.columns), F.lit(0)).alias("__n"))
    return agg.crossJoin(n_before).select(
        F.col("__n").cast("bigint").alias("null_count_total"),
        (F.col("__a") - F.col("__b")).alias("row_count_delta"),
        F.lit(len(after.columns) - len(before.columns)).alias("feature_count_delta"),
        F.lit(len(after.columns)).alias("engineered_columns"))
