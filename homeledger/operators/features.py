"""Feature engineering (#20-#22, #45-#52).

The transforms are applied in a fixed order.  Fitted statistics (modes, group
medians, category lists) belong to a :class:`ListingFeaturesModel`, which is
saved and loaded like any Spark ML model and encodes new rows as it did the
training rows.  Per-group medians are a table, joined back (AQE picks the
strategy); the others are single values.  Never a window partitioned by a
low-cardinality key (five styles would mean five tasks).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homeledger.functions.columns import nan_to_null, season_of
from homeledger.functions.quantiles import count_values, counted_quantiles, with_filled
from homeledger.schema import (
    DEFAULT_MONTH, DEFAULT_SEASON, LISTING_KEYS, MEDIAN_IMPUTE_PLAN, NON_FEATURE_COLUMNS,
    ONE_HOT_COLUMNS,
)
from homeledger.session import ensure_checkpoint_dir, is_filtered_table, materialize, scratch_scope



@dataclass
class FeatureRun:
    """Names of the transforms applied, in order (the run log's ``transforms_applied``)."""
    applied: list[str] = field(default_factory=list)
    categories: dict[str, list[str]] = field(default_factory=dict)
    model: ListingFeaturesModel | None = None


def drop_unnecessary_columns(df: DataFrame) -> DataFrame:
    """#20: tolerant drop of the non-feature columns that exist."""
    return df.drop(*[c for c in NON_FEATURE_COLUMNS if c in df.columns])


def drop_days_on_mls(df: DataFrame) -> DataFrame:
    """#21"""
    return df.drop("days_on_mls") if "days_on_mls" in df.columns else df


def _month_and_season(df: DataFrame) -> DataFrame:
    return df.withColumn("__m", F.month(F.try_to_date(F.col("list_date")))).withColumn("__s", season_of(F.col("__m")))


def date_modes(df: DataFrame) -> tuple[int, str]:
    """Most frequent sale month and season (ties -> smallest), or the defaults where there is none."""
    row = _month_and_season(df).agg(F.mode("__m", True).alias("m"), F.mode("__s", True).alias("s")).first()
    return row["m"] if row["m"] is not None else DEFAULT_MONTH, row["s"] or DEFAULT_SEASON


def list_date_features(df: DataFrame, modes: tuple[int, str] | None = None) -> DataFrame:
    """#45: sale_month / sale_season from list_date; gaps take the modes (of ``df`` unless given)."""
    if "list_date" not in df.columns:
        return df
    month, season = modes or date_modes(df)
    return _month_and_season(df).select(
        *[F.col(f"`{c}`") for c in df.columns if c != "list_date"],
        F.coalesce("__m", F.lit(month)).cast("int").alias("sale_month"),
        F.coalesce("__s", F.lit(season)).alias("sale_season"))


def drop_null_style_city(df: DataFrame) -> DataFrame:
    """#22"""
    return df.na.drop(subset=[c for c in ("style", "city") if c in df.columns])


def impute_absence(df: DataFrame) -> DataFrame:
    """#46: hoa_fee / half_baths / parking_garage: missing means none; flags from presence."""
    out = df
    if "hoa_fee" in df.columns:
        out = out.withColumn("has_hoa", F.col("hoa_fee").isNotNull().cast("int")) \
                 .withColumn("hoa_fee", F.coalesce(F.col("hoa_fee").cast("double"), F.lit(0.0)))
    if "half_baths" in df.columns:
        out = out.withColumn("half_baths", F.coalesce(F.col("half_baths"), F.lit(0)).cast("int"))
    if "parking_garage" in df.columns:
        out = out.withColumn("has_garage", F.col("parking_garage").isNotNull().cast("int")) \
                 .withColumn("parking_garage", F.coalesce(F.col("parking_garage"), F.lit(0)).cast("int"))
    return out


@dataclass
class MedianBatch:
    """Fitted medians of columns that share their group keys."""
    columns: list[str]
    keys: list[str]
    table: DataFrame                    # keys, __g_<column>
    overall: dict[str, float | None]    # median of the filled column, for rows whose group has none


def fit_medians(df: DataFrame, plan) -> list[MedianBatch]:
    """Medians of an ordered imputation plan from ONE counting pass over the rows.

    The rows are counted once by (all group keys, column, value), missing values
    included.  Each batch then works on counts: group medians; what they fill
    in is added to the counts, which gives the overall median of the filled
    column; and where a filled column is a later batch's key, the counts' key is
    filled the same way.
    """
    df = nan_to_null(df)
    batches = impute_batches(plan, df.columns)
    columns = [c for cols, _ in batches for c in cols]
    keys = list(dict.fromkeys(k for _, ks in batches for k in ks))
    number, name = {c: i for i, c in enumerate(columns)}, {k: f"g{i}" for i, k in enumerate(keys)}
    numeric = [k for k in keys if k in number]  # a key that an earlier batch fills becomes a double there
    counted = count_values(df.withColumns({k: F.col(f"`{k}`").cast("double") for k in numeric}), columns, keys, nulls=True)
    out = []
    for cols, by in batches:
        group = [name[k] for k in by]
        own = counted.where(F.col("item").isin([number[c] for c in cols]))
        med = counted_quantiles(own, columns, [0.5], group)
        table = materialize(med.select(*[F.col(name[k]).alias(k) for k in by],
                                       *[F.col(f"`__q_{c}`")[0].alias(f"__g_{c}") for c in cols]), "group-medians")
        of_group = table.select(*[F.col(f"`{k}`").alias(name[k]) for k in by], F.inline(F.array(*[
            F.struct(F.lit(number[c]).alias("item"), F.col(f"`__g_{c}`").alias("m")) for c in cols])))
        fills = (own.where("v IS NULL").join(of_group, [*group, "item"]).where("m IS NOT NULL")
                 .groupBy("item", F.col("m").alias("v")).agg(F.sum("c").alias("c")))
        one = counted_quantiles(with_filled(own, fills), columns, [0.5]).first()
        overall = {c: (one[f"__q_{c}"] or [None])[0] for c in cols}
        for c in cols:
            if c in numeric:
                key = name[c]
                counted = (counted.join(table.select(*[F.col(f"`{k}`").alias(name[k]) for k in by], f"__g_{c}"), group, "left")
                           .withColumn(key, F.coalesce(key, f"__g_{c}", F.lit(overall[c]).cast("double"))).drop(f"__g_{c}"))
        out.append(MedianBatch(cols, by, table, overall))
    return out


def fill_medians(df: DataFrame, fitted: list[MedianBatch]) -> DataFrame:
    """Fill gaps with the group's median, then with the overall one (a null key has no group)."""
    out = nan_to_null(df)
    for b in fitted:
        value = lambda c: F.coalesce(
            F.col(f"`{c}`").cast("double"), F.col(f"`__g_{c}`"), F.lit(b.overall[c]).cast("double")).alias(c)  # noqa: B023
        out = out.join(b.table, b.keys, "left").select(*[value(c) if c in b.columns else F.col(f"`{c}`")
                                                         for c in df.columns])
    return out


def grouped_median_impute(df: DataFrame, col: str, keys: list[str]) -> DataFrame:
    """#47: one column, group median then global median."""
    if col not in df.columns:
        return df
    return fill_medians(df, fit_medians(df, [(col, keys)]))


def impute_batches(plan, columns) -> list[tuple[list[str], list[str]]]:
    """Fuse the ordered imputation plan into as few grouped aggregates as possible
    without changing results.  A step joins an earlier batch with the same keys
    when its keys were filled before that batch and no earlier step groups by
    the column it fills (a group median depends only on its own column and keys)."""
    batches: list[tuple[list[str], list[str]]] = []
    filled_at: dict[str, int] = {}
    for i, (col, keys) in enumerate(plan):
        if col not in columns:
            continue
        used_as_key_before = any(col in k for _, k in plan[:i])
        need = max([filled_at[k] for k in keys if k in filled_at], default=-1)
        target = None
        if not used_as_key_before:
            target = next((b for b in range(need + 1, len(batches)) if batches[b][1] == list(keys)), None)
        if target is None:
            batches.append(([col], list(keys)))
            target = len(batches) - 1
        else:
            batches[target][0].append(col)
        filled_at[col] = target
    return batches


def impute_low_null(df: DataFrame, plan=MEDIAN_IMPUTE_PLAN) -> DataFrame:
    """#48: year_built, beds, stories, lot_sqft by style; sqft, full_baths by
    style + filled beds, all from one count of the rows."""
    return fill_medians(df, fit_medians(df, plan))


def category_values(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-null values per column (one distinct aggregation job)."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in present])))
    # each value becomes a column of the encoded table, so the list is its schema
    rows = pairs.where("v IS NOT NULL").distinct().collect()
    out = {c: [] for c in present}
    for r in rows:
        out[r["c"]].append(r["v"])
    return {c: sorted(v) for c, v in out.items()}


def _flag(c: str) -> Column:
    """A boolean as 0 / 1; a missing one has no code and raises."""
    return F.coalesce(F.col(f"`{c}`").cast("int"), F.raise_error(F.lit(f"{c} has a missing value")).cast("int")).alias(c)


def one_hot_encode(df: DataFrame, categories: dict[str, list[str]] | None = None,
                   columns: list[str] = ONE_HOT_COLUMNS) -> tuple[DataFrame, dict[str, list[str]]]:
    """#49: drop-first dummies (alphabetically first category is the baseline),
    null -> all zeros, single-valued column vanishes; new_construction -> int
    (a missing one raises).  All dummies are built in ONE select.

    For columns of very many values use :func:`sparse_encode`, which keeps them
    as a table."""
    present = [c for c in columns if c in df.columns]
    if categories is None:
        categories = category_values(df, present)
    base = [_flag(c) if c == "new_construction" else F.col(f"`{c}`") for c in df.columns if c not in present]
    dummies: list[Column] = []
    for c in present:
        src = F.col(f"`{c}`").cast("string")
        for v in categories.get(c, [])[1:]:
            dummies.append(F.when(src == v, 1).otherwise(0).alias(f"{c}_{v}"))
    return df.select(*base, *dummies), categories


def category_index(df: DataFrame, columns: list[str] = ONE_HOT_COLUMNS) -> DataFrame:
    """Written table (grp, value, position): every non-null value's 0-based place in its column's order.

    Values are dealt by range and numbered inside their partition, after a
    prefix over the partitions' counts: no task holds a column's values.
    """
    present = [c for c in columns if c in df.columns]
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("item"), F.lit(c).alias("grp"), F.col(f"`{c}`").cast("string").alias("value"))
        for i, c in enumerate(present)])))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(pairs.where("value IS NOT NULL").distinct().repartitionByRange(parts, "item", "value")
                        .withColumn("part", F.spark_partition_id()), "categories")
    before = Window.partitionBy("item").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (dealt.groupBy("item", "part").agg(F.count(F.lit(1)).alias("s"))
            .select("item", "part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("below")))
    inside = Window.partitionBy("item", "part").orderBy("value")
    return materialize(dealt.join(sums, ["item", "part"]).select(
        "grp", "value", (F.row_number().over(inside) - 1 + F.col("below")).alias("position")), "category-index")


def sparse_encode(df: DataFrame, index: DataFrame, numeric: list[str], columns: list[str] = ONE_HOT_COLUMNS,
                  output: str = "features") -> tuple[DataFrame, list[tuple[str, int]]]:
    """#49 for any number of categories: numeric columns, then the dummies, as ONE sparse vector.

    The index is joined on, column by column, so neither plan nor driver lists
    the values; a column's dummies take as many slots as it has values less the
    baseline (position 0).  Null, baseline and unknown values have no slot set.
    Returns the rows and the layout: (column, slots) in vector order.
    """
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler

    present = [c for c in columns if c in df.columns]
    sizes = {r["grp"]: r["n"] for r in index.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    used = [c for c in present if sizes.get(c, 0) > 1]
    out = df
    for c in used:
        # the encoder drops the last slot: it takes the baseline and what is missing or unknown
        slot = index.where((F.col("grp") == c) & (F.col("position") > 0)).select(
            F.col("value").alias(f"__v_{c}"), (F.col("position") - 1).cast("double").alias(f"__i_{c}"))
        out = (out.join(slot, F.col(f"`{c}`").cast("string") == F.col(f"`__v_{c}`"), "left").drop(f"__v_{c}")
               .withColumn(f"__i_{c}", F.coalesce(f"__i_{c}", F.lit(float(sizes[c] - 1)))))
    layout = [(c, 1) for c in numeric]
    vectors = []
    if used:
        ends = df.sparkSession.createDataFrame([tuple(float(sizes[c] - 1) for c in used)],
                                               ", ".join(f"`__i_{c}` double" for c in used))
        encoder = OneHotEncoder(inputCols=[f"__i_{c}" for c in used], outputCols=[f"__d_{c}" for c in used])
        out = encoder.fit(ends).transform(out)
        vectors = [f"__d_{c}" for c in used]
        layout += [(c, sizes[c] - 1) for c in used]
    out = VectorAssembler(inputCols=[*numeric, *vectors], outputCol=output, handleInvalid="error").transform(out)
    return out.drop(*[f"__i_{c}" for c in used], *vectors), layout


def dummy_columns(categories: dict[str, list[str]]) -> list[str]:
    return [f"{c}_{v}" for c, vals in categories.items() for v in vals[1:]]


class ListingFeatures(Estimator):
    """#50: learns what the feature transforms need from training rows: modes, medians, categories."""

    def __init__(self, plan=MEDIAN_IMPUTE_PLAN, columns: list[str] = ONE_HOT_COLUMNS):
        super().__init__()
        self.plan, self.columns = list(plan), list(columns)

    def _fit(self, df: DataFrame) -> ListingFeaturesModel:
        df = drop_days_on_mls(drop_unnecessary_columns(df))
        modes = date_modes(df) if "list_date" in df.columns else None
        base = impute_absence(drop_null_style_city(list_date_features(df, modes)))
        return ListingFeaturesModel(modes, fit_medians(base, self.plan), category_values(base, self.columns), self.columns)


class ListingFeaturesModel(Model, MLWritable, MLReadable):
    """Fitted feature statistics: ``transform`` encodes training rows and new rows alike.

    Saved as metadata (modes, overall medians, columns) and Parquet tables
    (group medians, one folder per batch, and categories).
    """

    def __init__(self, modes=None, medians=(), categories=None, columns=()):
        super().__init__()
        self.modes, self.medians = modes, list(medians)
        self.categories, self.columns = dict(categories or {}), list(columns)

    def fill(self, df: DataFrame) -> DataFrame:
        """The rows before the dummies: all gaps filled, new_construction as 0 / 1, categories as text."""
        out = drop_days_on_mls(drop_unnecessary_columns(df))
        out = fill_medians(impute_absence(drop_null_style_city(list_date_features(out, self.modes))), self.medians)
        return out.select(*[_flag(c) if c == "new_construction" else F.col(f"`{c}`") for c in out.columns])

    def encode(self, filled: DataFrame) -> DataFrame:
        """The dummies of filled rows."""
        return one_hot_encode(filled, self.categories, self.columns)[0]

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.encode(self.fill(df))

    def write(self) -> MLWriter:
        return _FeaturesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FeaturesReader()


class _FeaturesWriter(MLWriter):
    def __init__(self, model: ListingFeaturesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={
            "modes": m.modes, "columns": m.columns,
            "batches": [{"columns": b.columns, "keys": b.keys, "overall": b.overall} for b in m.medians]})
        for i, b in enumerate(m.medians):
            b.table.write.parquet(f"{path}/medians-{i}")
        rows = [(c, v) for c, values in m.categories.items() for v in values]
        self.sparkSession.createDataFrame(rows, "grp string, value string").write.parquet(f"{path}/categories")


class _FeaturesReader(MLReader):
    def load(self, path: str) -> ListingFeaturesModel:
        spark = self.sparkSession
        meta = DefaultParamsReader.loadMetadata(path, spark)
        medians = [MedianBatch(b["columns"], b["keys"], spark.read.parquet(f"{path}/medians-{i}"), b["overall"])
                   for i, b in enumerate(meta["batches"])]
        categories = {}
        for r in spark.read.parquet(f"{path}/categories").orderBy("grp", "value").collect():
            categories.setdefault(r["grp"], []).append(r["value"])
        ordered = {c: categories.get(c, []) for c in meta["columns"] if c in categories}
        return ListingFeaturesModel(tuple(meta["modes"]) if meta["modes"] else None, medians, ordered, meta["columns"])


def feature_pipeline(df: DataFrame, run: FeatureRun | None = None,
                     keep: list[str] = LISTING_KEYS, checkpoint: bool = True) -> DataFrame:
    """#50: the transforms in order.  ``keep`` columns ride along as row ids.

    ``checkpoint=True`` (default) cuts lineage with Parquet tables in the
    shared checkpoint dir (they survive executor loss): the input snapshot
    (after the column drops) is written once, unless it is a stored table with a
    filter, so the mode, median and category passes scan it instead of
    recomputing the upstream joins and dedup; the filled rows are written for training and scoring.  Dummies
    are comparisons of a stored text column: a reader makes those it asks for,
    which costs less than to write and read a column per category.
    ``run`` gets the fitted model, which encodes later rows the same way.
    """
    run = run if run is not None else FeatureRun()
    ensure_checkpoint_dir(df.sparkSession)
    out = drop_days_on_mls(drop_unnecessary_columns(df))
    with scratch_scope(df.sparkSession) as scope:
        if checkpoint and not is_filtered_table(out):  # the pipeline's input snapshot, minus the dropped columns
            out = materialize(out, "features-input")
        run.model = ListingFeatures().fit(out)
        run.categories = run.model.categories
        out = run.model.fill(out)
        if checkpoint:  # the engineered snapshot: training, bounds and scoring all read it
            out = materialize(out, "engineered")
        scope.keep(out, *[b.table for b in run.model.medians])
    out = run.model.encode(out)
    run.applied += ["drop_non_feature_columns", "drop_days_on_mls", "extract_list_date_features",
                    "drop_near_zero_null_rows", "impute_high_null_columns", "grouped_median_impute_low_null",
                    "one_hot_encode_categoricals", "final_null_audit"]
    return out


def feature_columns(df: DataFrame, target: str = "sold_price", keep: list[str] = LISTING_KEYS) -> list[str]:
    return [c for c in df.columns if c != target and c not in keep]


def skew_report(df: DataFrame) -> DataFrame:
    """#52: rows where the train-time flag (present) and the score-time flag (> 0) differ."""
    return df.select(
        F.count_if(F.col("hoa_fee").isNotNull() != F.coalesce(F.col("hoa_fee") > 0, F.lit(False)))
         .alias("has_hoa_mismatch"),
        F.count_if(F.col("parking_garage").isNotNull() != F.coalesce(F.col("parking_garage") > 0, F.lit(False)))
         .alias("has_garage_mismatch"),
        F.count(F.lit(1)).alias("rows"))


def category_dictionary(df: DataFrame, columns: list[str] = ONE_HOT_COLUMNS) -> DataFrame:
    """#51 (data side): (group, value, is_baseline, position) — sorted distinct
    values per categorical column; the first one is the dropped baseline."""
    present = [c for c in columns if c in df.columns]
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("grp"), F.col(f"`{c}`").cast("string").alias("value")) for c in present])))
    d = pairs.where("value IS NOT NULL").distinct()
    w = Window.partitionBy("grp").orderBy("value")
    return d.select("grp", "value", (F.dense_rank().over(w) == 1).alias("is_baseline"),
                    F.dense_rank().over(w).cast("int").alias("position"))
