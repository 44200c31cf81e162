"""Model training, cross-validation, metrics and the model registry (#53-#65).

Fits are Spark ML jobs (tree aggregation is distributed); the driver only
holds the trial table.  Metrics come from ONE grouped aggregate over stored
predictions, so any prediction table (in-sample, per fold, held-out) is
scored the same way.  The registry is a table: promotion is a running max
over versions, computed as a two-level prefix max so no step needs all
versions in one task.
"""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from homeledger.session import Scope, scratch_path, scratch_scope, write_scratch

TARGET = "sold_price"
MAX_DEPTH = 30  # Spark ML trees stop at depth 30


# ---------------------------------------------------------------- training
def _assembler(features: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error")


def forest_estimator(params: dict | None = None, seed: int = 42) -> RandomForestRegressor:
    p = {"numTrees": 20, "maxDepth": 8, "minInstancesPerNode": 1, "featureSubsetStrategy": "onethird"}
    p.update(params or {})
    return RandomForestRegressor(labelCol=TARGET, featuresCol="features", seed=seed, **p)


def boosted_estimator(params: dict | None = None, seed: int = 42) -> GBTRegressor:
    p = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "subsamplingRate": 1.0,
         "featureSubsetStrategy": "all", "minInstancesPerNode": 1, "minInfoGain": 0.0}
    p.update(params or {})
    return GBTRegressor(labelCol=TARGET, featuresCol="features", seed=seed, **p)


def estimator(model_type: str, params: dict | None = None, seed: int = 42):
    return forest_estimator(params, seed) if model_type == "rf" else boosted_estimator(params, seed)


PARTITION_BYTES = 64 << 20  # binned rows that one training task holds
PARALLEL_BYTES = 4 << 30    # binned rows of all fits that run at a time


def binned_bytes(n_features: int) -> int:
    """Memory of a training row: the trees hold one number per feature, whatever the stored row takes."""
    return 4 * n_features + 160


def fit_rows(df: DataFrame, n_features: int, path: str | None = None) -> DataFrame:
    """Assembled rows written once and read as many small partitions.

    A stored row of many dummies takes a tenth of its binned size, so the usual
    split size would give a task over a gigabyte to hold.  Files are cut at
    ``PARTITION_BYTES`` of binned rows, and the table is read in a session of
    its own whose splits are single files: their number grows with the rows,
    and no row is shuffled.
    """
    path = path or scratch_path(df.sparkSession, "fit-rows")
    limit = max(1000, PARTITION_BYTES // binned_bytes(n_features))
    write_scratch(df, path, mode="overwrite", maxRecordsPerFile=limit)
    return read_fit_rows(df.sparkSession, path)


def read_fit_rows(spark, path: str) -> DataFrame:
    """The table of :func:`fit_rows`, one partition a file, in the order they were written: trees draw their
    rows by partition, and a file system may list files of one size in any order."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(256 << 20))
    own.conf.set("spark.sql.files.openCostInBytes", str(256 << 20))
    return own.read.parquet(*sorted(own.read.parquet(path).inputFiles()))


def fits_at_a_time(rows: DataFrame, n_features: int, most: int) -> int:
    """How many fits may hold their binned rows side by side: ``most`` of small tables, one of large ones."""
    return max(1, min(most, PARALLEL_BYTES // max(1, rows.count() * binned_bytes(n_features))))


def train(df: DataFrame, features: list[str], model_type: str = "rf", params: dict | None = None,
          seed: int = 42, scope: Scope | None = None) -> PipelineModel:
    """#53 / #54: fit assembler + forest ('rf') or boosted trees ('gbt') on the whole table.

    The tables of ``scope`` are removed once the assembled rows are written:
    the trees need the disk for binned rows that outgrow the memory.
    """
    assembler = _assembler(features)
    with scratch_scope(df.sparkSession):  # the fitted trees need the rows no longer
        rows = fit_rows(assembler.transform(df).select(TARGET, "features"), len(features))
        if scope is not None:
            scope.clear(df.sparkSession, rows)
        return PipelineModel([assembler, estimator(model_type, params, seed).fit(rows)])


def split_target(df: DataFrame, features: list[str], target: str = TARGET,
                 keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """#12: (y, X), y with the row keys ``keep``; a missing target or feature column raises,
    naming the first five."""
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"{len(missing)} feature columns missing, e.g. {missing[:5]}")
    return df.select(*keep, target), df.select(*[F.col(f"`{c}`") for c in features])


def save_model(model: PipelineModel, path: str) -> None:
    """#65: persist the fitted pipeline (assembler + trees)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --------------------------------------------------------- folds and CV
def with_folds(df: DataFrame, k: int, seed: int, key: list[str]) -> DataFrame:
    """Hash folds: fold = pmod(xxhash64(key, seed), k) — stable under repartitioning."""
    return df.withColumn("fold", F.pmod(F.xxhash64(*[F.col(c) for c in key], F.lit(seed)), F.lit(k)).cast("int"))


def oof_predictions(df: DataFrame, features: list[str], model_type: str = "rf", params: dict | None = None,
                    k: int = 3, seed: int = 42, key: list[str] | None = None,
                    keep: list[str] | None = None, parallel: int = 5, scope: Scope | None = None) -> DataFrame:
    """#66: each row scored by a model fitted without its fold.

    The rows are assembled once and written; the k fits read them, up to
    ``parallel`` at a time, so one fit's small stages fill another's gaps; fits
    of large tables follow one another, as each needs the memory for its rows.
    The tables of ``scope`` are removed before the fits, as in :func:`train`.
    """
    keep = keep or []
    key = key or keep
    path = scratch_path(df.sparkSession, "fold-rows")
    stored = _assembler(features).transform(df).select(*dict.fromkeys([*keep, *key]), TARGET, "features")
    # folds are made by the reader: a hash beside all dummies in one projection is eight times slower to write
    rows = with_folds(fit_rows(stored, len(features), path), k, seed, key)
    parallel = fits_at_a_time(rows, len(features), parallel)
    if scope is not None:
        scope.clear(df.sparkSession, rows)

    def fit(f: int):
        return estimator(model_type, params, seed).fit(rows.where(F.col("fold") != f))

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        models = list(pool.map(inheritable_thread_target(df.sparkSession)(fit), range(k)))
    rows = with_folds(df.sparkSession.read.parquet(path), k, seed, key)
    parts = [m.transform(rows.where(F.col("fold") == f)).select(
        *keep, "fold", F.col(TARGET).alias("actual"), F.col("prediction").alias("predicted"))
        for f, m in enumerate(models)]
    return reduce(DataFrame.unionByName, parts)


def regression_metrics(pred: DataFrame, n_features: int, by: list[str] | None = None,
                       actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """#56 / #57: n, R², adjusted R², RMSE, MAE — ONE aggregate (per group).

    R² = 1 - SSE / SST with SST = n · var_pop(y), over rows that have both
    values; adjusted R² is NULL when n - p - 1 <= 0 instead of a meaningless or
    infinite value.
    """
    by = by or []
    both = pred.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    y, yh = F.col(actual), F.col(predicted)
    g = both.groupBy(*by) if by else both.groupBy()
    agg = g.agg(F.count(y).alias("n"), F.var_pop(y).alias("__var"),
                F.sum((y - yh) * (y - yh)).alias("__sse"), F.sum(F.abs(y - yh)).alias("__sae"))
    sst = F.col("__var") * F.col("n")
    r2 = F.lit(1.0) - F.try_divide(F.col("__sse"), sst)
    dof = F.col("n") - F.lit(n_features) - F.lit(1)
    adj = F.when(dof > 0, F.lit(1.0) - (F.lit(1.0) - r2) * (F.col("n") - 1) / dof)
    return agg.select(*by, "n", r2.alias("r2"), adj.alias("adj_r2"),
                      F.sqrt(F.col("__sse") / F.col("n")).alias("rmse"), (F.col("__sae") / F.col("n")).alias("mae"))


def cv_scores(pred: DataFrame, n_features: int, fold_col: str = "fold") -> DataFrame:
    """#55: per-fold metrics in one grouped aggregate, then mean and population std."""
    m = regression_metrics(pred, n_features, [fold_col])
    return m.agg(F.avg("adj_r2").alias("cv_adj_r2_mean"), F.stddev_pop("adj_r2").alias("cv_adj_r2_std"),
                 F.avg("r2").alias("cv_r2_mean"), F.avg("rmse").alias("cv_rmse_mean"),
                 F.stddev_pop("rmse").alias("cv_rmse_std"), F.avg("mae").alias("cv_mae_mean"),
                 F.count(F.lit(1)).alias("folds"))


# ------------------------------------------------------------ search
# FIXED VALUES: search ranges (Spark ML trees stop at depth 30)
RF_SPACE = {"numTrees": (100, 800, 50), "maxDepth": (5, MAX_DEPTH, 1), "minInstancesPerNode": (1, 15, 1),
            "featureSubsetStrategy": ["sqrt", "log2", "0.3", "0.5", "0.7", "all"]}
GBT_SPACE = {"maxIter": (100, 1000, 50), "stepSize": (0.01, 0.3, "log"), "maxDepth": (3, 12, 1),
             "subsamplingRate": (0.5, 1.0, None), "minInstancesPerNode": (1, 10, 1),
             "minInfoGain": (1e-8, 5.0, "log"), "featureSubsetStrategy": ["0.5", "0.6", "0.7", "0.8", "0.9", "all"]}


def sample_params(space: dict, rng: random.Random) -> dict:
    out = {}
    for name, spec in space.items():
        if isinstance(spec, list):
            out[name] = rng.choice(spec)
        elif spec[2] == "log":
            import math
            out[name] = math.exp(rng.uniform(math.log(spec[0]), math.log(spec[1])))
        elif spec[2] is None:
            out[name] = rng.uniform(spec[0], spec[1])
        else:
            out[name] = rng.randrange(spec[0], spec[1] + 1, spec[2])
    return out


def feature_importance(model: PipelineModel, features: list[str], top: int = 15) -> DataFrame:
    """#68: top-N importances, descending (ties by name)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature")).limit(top)


# ------------------------------------------------------------ trials & registry
def best_trial(trials: DataFrame, trial_number: int, model_type: str) -> DataFrame:
    """#59: newest run with this trial number and model type; cv_* -> best_cv_* (4 places)."""
    t = trials.where((F.col("trial_number") == trial_number) & (F.col("model_type") == model_type))
    newest = t.agg(F.max_by(F.struct(*[F.col(c) for c in t.columns]),
                            F.struct("start_time", "run_id")).alias("b")).select("b.*")
    metrics = [c for c in t.columns if c.startswith("cv_")]
    return newest.where(F.col("run_id").isNotNull()).select(
        "run_id", "trial_number", "model_type",
        *[F.round(F.col(c), 4).alias("best_" + c) for c in metrics])


def session_best(trials: DataFrame, types: list[str] = ("rf", "gbt"), score: str = "cv_adj_r2_mean") -> DataFrame:
    """#60: the better model type by its best trial score; a tie keeps the first listed."""
    rank = F.create_map(*[x for i, t in enumerate(types) for x in (F.lit(t), F.lit(-i))])
    per = trials.groupBy("model_type").agg(F.max(score).alias("best_score"))
    return per.agg(F.max_by(F.struct("model_type", "best_score"),
                            F.struct("best_score", rank[F.col("model_type")])).alias("w")).select("w.*")


def _earlier_max(maxima: DataFrame, top: int, width: int) -> DataFrame:
    """(b, earlier): for each bucket ``b`` of (b, m) the largest ``m`` of all smaller buckets.

    Buckets are grouped by ``width``; where more than one group is left, the
    groups' own maxima take the same step, so no window holds more than
    ``width`` rows.
    """
    before = Window.partitionBy("u").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    inside = maxima.withColumn("u", F.floor(F.col("b") / F.lit(width))).withColumn("i", F.max("m").over(before))
    if top < width:
        return inside.select("b", F.col("i").alias("earlier"))
    outer = _earlier_max(inside.groupBy(F.col("u").alias("b")).agg(F.max("m").alias("m")), top // width, width)
    return inside.join(outer.withColumnRenamed("b", "u"), "u").select("b", F.greatest("i", "earlier").alias("earlier"))


def promote(versions: DataFrame, bucket_width: int = 100_000) -> DataFrame:
    """#61: per version — the incumbent's score (running max of earlier scores),
    promoted when round(score, 4) > incumbent strictly (no incumbent -> promoted).

    Running max = max(earlier buckets' max, max earlier in the same bucket), in
    as many levels as the largest version number needs: every window is
    partitioned and holds at most ``bucket_width`` rows.
    """
    v = versions.withColumn("score4", F.round("cv_adj_r2", 4)) \
                .withColumn("__b", F.floor(F.col("version") / F.lit(bucket_width)))
    top = versions.agg(F.max(F.abs("version"))).first()[0] or 0
    prior = _earlier_max(v.groupBy(F.col("__b").alias("b")).agg(F.max("score4").alias("m")), top // bucket_width, bucket_width)
    w = Window.partitionBy("__b").orderBy("version").rowsBetween(Window.unboundedPreceding, -1)
    j = v.withColumn("__in", F.max("score4").over(w)).join(prior.withColumnRenamed("b", "__b"), "__b")
    inc = F.greatest(F.col("__in"), F.col("earlier"))
    return j.select("version", "model_type", "score4", inc.alias("incumbent_score"),
                    F.coalesce(F.col("score4").isNotNull() & (inc.isNull() | (F.col("score4") > inc)), F.lit(False))
                    .alias("promoted")).select(
        "version", "model_type", F.col("score4").alias("cv_adj_r2"), "incumbent_score", "promoted",
        F.when(F.col("promoted"), "champion").otherwise("challenger").alias("status_at_registration"))


def aliases(decisions: DataFrame) -> DataFrame:
    """#61/#62: current alias -> version.  champion = last promoted; previous_champion
    = the promoted version before it (only when it had a scored incumbent);
    challenger = last version that was not promoted."""
    p = decisions.where("promoted")
    last2 = p.agg(F.max("version").alias("champ"))
    prev = p.join(last2, p.version < last2.champ).agg(F.max("version").alias("prev"))
    champ_inc = decisions.join(last2, decisions.version == last2.champ).select(
        F.col("incumbent_score").isNotNull().alias("had_incumbent"))
    chal = decisions.where("NOT promoted").agg(F.max("version").alias("chal"))
    row = last2.crossJoin(prev).crossJoin(champ_inc).crossJoin(chal)
    return row.select(F.inline(F.array(
        F.struct(F.lit("champion").alias("alias"), F.col("champ").alias("version")),
        F.struct(F.lit("previous_champion").alias("alias"),
                 F.when(F.col("had_incumbent"), F.col("prev")).alias("version")),
        F.struct(F.lit("challenger").alias("alias"), F.col("chal").alias("version"))))).where("version IS NOT NULL")


def find_champion(alias_table: DataFrame, versions: DataFrame, alias: str = "champion") -> DataFrame:
    """#62: the version holding ``alias`` with its details (empty when none)."""
    a = alias_table.where(F.col("alias") == alias)
    return a.join(versions, "version").select("alias", "version", "model_type", "cv_adj_r2", "run_id")


def version_history(versions: DataFrame, alias_table: DataFrame, n: int = 20) -> DataFrame:
    """#63: the n newest versions with their aliases (a top-n report)."""
    al = alias_table.groupBy("version").agg(F.array_join(F.array_sort(F.collect_list("alias")), ",").alias("aliases"))
    top = versions.orderBy(F.desc("version")).limit(n)
    return top.join(al, "version", "left").select(
        "version", "model_type", F.round("cv_adj_r2", 4).alias("cv_adj_r2"),
        F.coalesce("aliases", F.lit("")).alias("aliases"),
        F.date_format(F.expr("timestampadd(MILLISECOND, creation_timestamp, "
                                     "TIMESTAMP_NTZ'1970-01-01 00:00:00')"), "yyyy-MM-dd HH:mm").alias("created"))
