"""#24-#25: filter rules — split rows into kept/removed and log each rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from homeledger.functions.columns import any_of
from homeledger.functions.rules import parse_rule, predicate

SAMPLE_SIZE = 10


def removal_mask(df: DataFrame, rules: list[str]):
    parsed = [parse_rule(r) for r in rules]
    return any_of([predicate(r, df) for r in parsed])


def apply_filter_rules(df: DataFrame, rules: list[str]) -> tuple[DataFrame, DataFrame]:
    """#24: (kept, removed); removed = rows matching ANY rule.  Kept ∪ removed = input."""
    m = removal_mask(df, rules)
    return df.where(~m), df.where(m)


def split_column(df: DataFrame, rules: list[str]) -> DataFrame:
    """#24 as one pass: the input with ``split`` = 'removed' | 'kept' (for partitioned writes)."""
    m = removal_mask(df, rules)
    return df.withColumn("split", F.when(m, "removed").otherwise("kept"))


def filter_rule_log(df: DataFrame, rules: list[str], order_by: list[str]) -> DataFrame:
    """#25: per rule — matched rows and up to 10 sample values (first under ``order_by``).

    Counts: one aggregate over all rules.  Samples: rows explode into their
    matching rule ids and ``row_number() <= 10`` per rule; Spark plans that
    as a map-side WindowGroupLimit, so a rule matching a third of the table
    ships only ten rows per map task.
    """
    parsed = [parse_rule(r) for r in rules]
    preds = [predicate(r, df) for r in parsed]
    counts = df.agg(*[F.count_if(p).alias(f"__n{i}") for i, p in enumerate(preds)])
    meta = F.array(*[F.struct(F.lit(i).alias("rule_id"), F.lit(r.text).alias("rule"),
                              F.lit(r.column).alias("column"), F.lit(r.op).alias("operator"),
                              F.lit(r.value_text()).alias("value"),
                              F.col(f"__n{i}").alias("rows_removed"))
                     for i, r in enumerate(parsed)])
    log = counts.select(F.inline(meta))

    matched = F.filter(F.array(*[
        F.when(p, F.struct(F.lit(i).alias("rule_id"), F.col(f"`{r.column}`").cast("string").alias("v")))
        for i, (r, p) in enumerate(zip(parsed, preds))]), lambda h: h.isNotNull())
    hits = df.select(*[F.col(c) for c in order_by], F.explode(matched).alias("h"))
    w = Window.partitionBy("h.rule_id").orderBy(*order_by)
    top = (hits.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= SAMPLE_SIZE)
           .groupBy(F.col("h.rule_id").alias("rule_id"))
           .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__rn", F.col("h.v").alias("v")))),
                                         lambda s: s["v"]), ", ").alias("sample_values")))
    return log.join(top, "rule_id", "left").select(
        "rule_id", "rule", "column", "operator", "value", "rows_removed",
        F.coalesce("sample_values", F.lit("")).alias("sample_values"))
