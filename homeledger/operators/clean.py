"""Listing cleaning: empty rows, duplicates, missing target, style filter, IQR outliers.

Each step is ``DataFrame -> DataFrame``; :func:`clean_steps` also returns the
intermediate frames, :func:`clean_observed` counts every step (the cleaning log)
in the jobs that write the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from homeledger.functions.columns import all_of, scalar_columns
from homeledger.functions.quantiles import exact_quantiles
from homeledger.session import materialize
from homeledger.schema import IQR_MULTIPLIER, OUTLIER_COLUMNS, TARGET, VALID_STYLES


#: Hashes of repeated rows that are broadcast at most (8 bytes each).
MOST_REPEATED = 1 << 19


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """#13: remove rows whose every column is null."""
    return df.na.drop(how="all")


def deduplicate(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """#14: drop repeats on all scalar columns (null equals null).

    Nested columns (array/map/struct) are left out of the key, decided by
    schema type.  When every column is in the key, equal rows have equal hashes:
    only the hashes are shuffled, and rows whose hash comes once pass as they
    are.  The others (and where the repeated hashes are too many to broadcast,
    all rows) are compared whole by ``dropDuplicates``.  Otherwise the first row
    per key wins under ``order_by`` (an explicit order — Spark rows have none).
    """
    key = scalar_columns(df)
    if len(key) == len(df.columns):
        mark = "__row_hash"
        hashed = df.withColumn(mark, F.xxhash64(*[F.col(f"`{c}`") for c in key]))
        repeated = materialize(hashed.groupBy(mark).count().where("count > 1").select(mark), "repeated-rows")
        n = repeated.count()
        if n > MOST_REPEATED:
            return df.dropDuplicates(key)
        if not n:
            return df
        repeated = F.broadcast(repeated)
        once = hashed.join(repeated, mark, "left_anti").drop(mark)
        return once.unionByName(hashed.join(repeated, mark, "left_semi").drop(mark).dropDuplicates(key))
    if not order_by:
        raise ValueError("deduplicate: nested columns present; pass order_by to pick the kept row")
    w = Window.partitionBy(*[F.col(f"`{c}`") for c in key]).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def remove_missing_target(df: DataFrame, target: str = TARGET) -> DataFrame:
    """#15: drop rows without a sale price."""
    return df.na.drop(subset=[target])


def filter_style(df: DataFrame, valid_styles: list[str] = VALID_STYLES) -> DataFrame:
    """#16: keep wanted styles; a missing style is kept (dropped later by features)."""
    return df.where(F.col("style").isin(valid_styles) | F.col("style").isNull())


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """#26: text -> double, bad values and NaN become NULL (``try_cast``)."""
    present = [c for c in columns if c in df.columns]
    number = lambda c: F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return df.withColumns({c: F.when(~F.isnan(number(c)), number(c)) for c in present})


def iqr_bounds(df: DataFrame, columns: list[str] = OUTLIER_COLUMNS,
               multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """One-row table: exact q1/q3/lower/upper per column, all columns on the same
    input; the row (4 numbers per column) is broadcast back."""
    present = [c for c in columns if c in df.columns]
    q = exact_quantiles(df, present, [0.25, 0.75])
    out = []
    for c in present:
        q1 = F.col(f"__q_{c}")[0]
        q3 = F.col(f"__q_{c}")[1]
        iqr = q3 - q1
        out += [q1.alias(f"{c}__q1"), q3.alias(f"{c}__q3"),
                (q1 - F.lit(multiplier) * iqr).alias(f"{c}__lo"),
                (q3 + F.lit(multiplier) * iqr).alias(f"{c}__hi")]
    return q.select(*out)


def _inside(c: str, lo: F.Column, hi: F.Column) -> F.Column:
    v = F.expr(f"try_cast(`{c}` AS DOUBLE)")
    return ((v >= lo) & (v <= hi)) | v.isNull()


def remove_outliers_iqr(df: DataFrame, columns: list[str] = OUTLIER_COLUMNS,
                        multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """#17: keep rows inside [Q1 - m*IQR, Q3 + m*IQR] on every column (null passes).

    The bounds (two numbers per column) are fetched once, so what is left is a
    filter that every reader of the rows can repeat.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    b = iqr_bounds(df, present, multiplier).first()
    bound = lambda c, end: F.lit(b[f"{c}__{end}"]).cast("double")
    return df.where(all_of([F.coalesce(_inside(c, bound(c, "lo"), bound(c, "hi")), F.lit(True)) for c in present]))


def outlier_report(df: DataFrame, columns: list[str] = OUTLIER_COLUMNS,
                   multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """#18: per column — outliers_found, lower/upper bound, Q1, Q3, IQR (2 places); one
    aggregate over the rows, its single row unpivoted."""
    present = [c for c in columns if c in df.columns]
    b = iqr_bounds(df, present, multiplier)
    counts = (df.crossJoin(F.broadcast(b))
                .agg(*[F.count_if(~F.coalesce(_inside(c, F.col(f"{c}__lo"), F.col(f"{c}__hi")), F.lit(True))).alias(f"{c}__n") for c in present]))
    return counts.crossJoin(F.broadcast(b)).select(F.inline(F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}__n").alias("outliers_found"),
            F.round(F.col(f"{c}__lo"), 2).alias("lower_bound"),
            F.round(F.col(f"{c}__hi"), 2).alias("upper_bound"),
            F.round(F.col(f"{c}__q1"), 2).alias("q1"),
            F.round(F.col(f"{c}__q3"), 2).alias("q3"),
            F.round(F.col(f"{c}__q3") - F.col(f"{c}__q1"), 2).alias("iqr"),
        ) for c in present])))


def clean_steps(df: DataFrame, multiplier: float = IQR_MULTIPLIER) -> dict[str, DataFrame]:
    """#19: the five steps in order; returns every intermediate frame.

    The deduplicated, filtered rows are written as a table in the shared
    checkpoint dir, so the quartile passes and the final filter read them
    instead of repeating the dedup shuffle.
    """
    s0 = df
    s1 = drop_empty_rows(s0)
    s2 = deduplicate(s1)
    s3 = remove_missing_target(s2)
    s4 = materialize(filter_style(s3), "clean-filtered")
    s5 = remove_outliers_iqr(s4, OUTLIER_COLUMNS, multiplier)
    return {"raw": s0, "non_empty": s1, "deduplicated": s2, "with_target": s3,
            "style_filtered": s4, "cleaned": s5}


def clean_data(df: DataFrame, multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """#19: cleaned listings."""
    return clean_steps(df, multiplier)["cleaned"]


def clean_observed(df: DataFrame, multiplier: float = IQR_MULTIPLIER) -> tuple[dict[str, DataFrame], DataFrame]:
    """#19 with #35: (``style_filtered`` and ``cleaned`` as written tables, the cleaning log).

    The log comes out of the two jobs that write the rows (``observe``); no
    scan serves it alone.  Equal rows are combined before the shuffle with
    their number of copies, empty ones included, so every count is taken in the
    writing stage itself, whose tasks count once even if an executor is lost
    and the stages before are run again.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    if len(scalar_columns(df)) < len(cols):
        raise ValueError("clean_observed: nested columns present; rows cannot be compared")
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")}
    empty = all_of([F.col(f"`{c}`").isNull() | (F.isnan(F.col(f"`{c}`")) if c in floats else F.lit(False)) for c in df.columns])
    copies = F.col("__copies")
    kept = ~F.coalesce(empty, F.lit(False))
    target = kept & ~(F.col(TARGET).isNull() | (F.isnan(TARGET) if TARGET in floats else F.lit(False)))
    styled = target & (F.col("style").isin(VALID_STYLES) | F.col("style").isNull())
    first, last = Observation(), Observation()
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    filtered = materialize(
        df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__copies"))
        .observe(first, total(copies).alias("raw"), total(F.when(kept, copies)).alias("non_empty"),
                 F.count_if(kept).alias("deduplicated"), F.count_if(target).alias("with_target"),
                 F.count_if(styled).alias("style_filtered"))
        .where(styled).select(*cols), "clean-filtered")
    cleaned = materialize(remove_outliers_iqr(filtered, OUTLIER_COLUMNS, multiplier)
                          .observe(last, F.count(F.lit(1)).alias("cleaned")), "cleaned")
    counts = {**first.get, **last.get}
    names = ["raw", "non_empty", "deduplicated", "with_target", "style_filtered", "cleaned"]
    row = df.sparkSession.range(1).select(*[F.lit(int(counts.get(n) or 0)).cast("long").alias(n) for n in names])
    return {"style_filtered": filtered, "cleaned": cleaned}, _log_row(row, len(cols))


def cleaning_log(df: DataFrame, multiplier: float = IQR_MULTIPLIER) -> DataFrame:
    """#35: rows before/after, rows dropped per step, total and percent removed."""
    return clean_observed(df, multiplier)[1]


def _log_row(counts: DataFrame, n_columns: int) -> DataFrame:
    return counts.select(
        F.col("raw").alias("raw_rows"),
        F.lit(n_columns).alias("raw_columns"),
        (F.col("raw") - F.col("non_empty")).alias("empty_rows_dropped"),
        (F.col("non_empty") - F.col("deduplicated")).alias("duplicates_dropped"),
        (F.col("deduplicated") - F.col("with_target")).alias("missing_target_dropped"),
        (F.col("with_target") - F.col("style_filtered")).alias("style_filter_dropped"),
        (F.col("style_filtered") - F.col("cleaned")).alias("outliers_dropped"),
        F.col("cleaned").alias("cleaned_rows"),
        (F.col("raw") - F.col("cleaned")).alias("total_rows_removed"),
        F.round(F.lit(100.0) * (F.col("raw") - F.col("cleaned")) / F.greatest(F.col("raw"), F.lit(1)), 2)
         .alias("removal_pct"),
    )
