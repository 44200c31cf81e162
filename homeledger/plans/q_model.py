"""Queries for training, selection and the registry (12, 53-66, 68) and evaluation (11, 67, 70, 72-75)."""

from __future__ import annotations

from pyspark.sql import functions as F

from homeledger.operators import clean as C
from homeledger.operators import evaluate as EV
from homeledger.operators import features as FE
from homeledger.operators import model as M
from homeledger.operators import search as SR
from homeledger.plans import standins as S
from homeledger.plans.registry import register
from homeledger.plans.sqlbits import KEYS_SQL, feature_ctes, with_cleaned, with_listings
from homeledger.schema import LISTING_KEYS, ONE_HOT_COLUMNS
from homeledger.session import materialize, scratch_path, scratch_scope
from homeledger.sources.fixture import listings

P = 10  # feature count used by the adjusted-R² formulas on stored predictions
# the registered search: the whole ranges, 10 candidates a type, 5 folds; the last rung has a candidate's own number of trees
SEARCH = SR.SearchPlan(candidates=10, folds=5, seed=42, eta=3, first_trees=1, parallel=6)
TOP_GROUPS = 5
NUMERIC = ["year_built", "sqft", "beds", "full_baths", "half_baths", "lot_sqft", "stories",
           "parking_garage", "hoa_fee", "sale_month"]


def r4(c):
    return F.round(F.col(c), 4).alias(c)


def _training(spark, sf):
    with scratch_scope(spark) as scope:
        eng = scope.keep(FE.feature_pipeline(C.clean_data(listings(spark, sf))))
    return eng, FE.feature_columns(eng)


# ------------------------------------------------------------------ stored predictions (D)
def _metric_sql(by: str | None):
    g = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return (f"SELECT {g}n, 1 - sse / (syy - sy * sy / n) AS r2, "
            f"CASE WHEN n - {P} - 1 > 0 THEN 1 - (sse / (syy - sy * sy / n)) * (n - 1) / (n - {P} - 1) END AS adj_r2, "
            f"sqrt(sse / n) AS rmse, sae / n AS mae FROM (SELECT {g}count(actual) AS n, sum(actual) AS sy, "
            f"sum(actual * actual) AS syy, sum((actual - predicted) * (actual - predicted)) AS sse, "
            f"sum(abs(actual - predicted)) AS sae FROM preds{grp})")


@register("adjusted_r2", lambda: with_cleaned(S.PREDICTIONS_SQL) +
          f"SELECT fold, n, round(r2, 4) AS r2, round(adj_r2, 4) AS adj_r2 FROM ({_metric_sql('fold')})")
def q_adjusted_r2(spark, sf):
    m = M.regression_metrics(S.stored_predictions(spark, sf), P, ["fold"])
    return m.select("fold", "n", r4("r2"), r4("adj_r2"))


@register("train_metrics", lambda: with_cleaned(S.PREDICTIONS_SQL) +
          f"SELECT n, round(r2, 4) AS r2, round(adj_r2, 4) AS adj_r2, round(rmse, 4) AS rmse, "
          f"round(mae, 4) AS mae FROM ({_metric_sql(None)})")
def q_train_metrics(spark, sf):
    m = M.regression_metrics(S.stored_predictions(spark, sf), P)
    return m.select("n", r4("r2"), r4("adj_r2"), r4("rmse"), r4("mae"))


@register("cv_scores", lambda: with_cleaned(S.PREDICTIONS_SQL) +
          "SELECT round(avg(adj_r2), 4) AS cv_adj_r2_mean, round(stddev_pop(adj_r2), 4) AS cv_adj_r2_std, "
          "round(avg(r2), 4) AS cv_r2_mean, round(avg(rmse), 4) AS cv_rmse_mean, round(stddev_pop(rmse), 4) "
          f"AS cv_rmse_std, round(avg(mae), 4) AS cv_mae_mean, count(*) AS folds FROM ({_metric_sql('fold')})")
def q_cv_scores(spark, sf):
    s = M.cv_scores(S.stored_predictions(spark, sf), P)
    return s.select(*[r4(c) for c in s.columns if c != "folds"], "folds")


@register("write_predictions", lambda: with_cleaned(S.PREDICTIONS_SQL) +
          f"SELECT {KEYS_SQL}, actual, predicted, round(abs(predicted - actual), 4) AS abs_error, "
          f"round(abs(predicted - actual) * 100.0 / actual, 4) AS abs_pct_error FROM preds")
def q_write_predictions(spark, sf):
    """The predictions are written and read back."""
    rows = EV.prediction_rows(S.stored_predictions(spark, sf), "actual", "predicted", LISTING_KEYS)
    p = materialize(rows, "predictions")
    return p.select(*LISTING_KEYS, "actual", "predicted", r4("abs_error"), r4("abs_pct_error"))


@register("business_metrics", lambda: with_cleaned(S.PREDICTIONS_SQL) +
          "SELECT round(median(pct), 4) AS median_abs_pct_error, round(avg(pct), 4) AS mean_abs_pct_error, "
          "round(count(*) FILTER (WHERE pct <= 5) * 100.0 / count(*), 4) AS pct_within_5, "
          "round(count(*) FILTER (WHERE pct <= 10) * 100.0 / count(*), 4) AS pct_within_10, "
          "round(count(*) FILTER (WHERE pct <= 20) * 100.0 / count(*), 4) AS pct_within_20, "
          "round(median(err), 4) AS median_abs_error_dollars, round(avg(err), 4) AS mean_abs_error_dollars, "
          "round(sqrt(avg(err * err)), 4) AS rmse_dollars, count(*) AS n_predictions FROM "
          "(SELECT abs(predicted - actual) AS err, abs(predicted - actual) * 100.0 / actual AS pct FROM preds)")
def q_business_metrics(spark, sf):
    p = EV.prediction_rows(S.stored_predictions(spark, sf), "actual", "predicted")
    b = EV.business_metrics(p)
    return b.select(*[r4(c) for c in b.columns if c != "n_predictions"], "n_predictions")


# ------------------------------------------------------------------ trials and registry (D)
@register("best_trial", lambda: with_listings(S.TRIALS_SQL) +
          "SELECT run_id, trial_number, model_type, round(cv_adj_r2_mean, 4) AS best_cv_adj_r2_mean, "
          "round(cv_adj_r2_std, 4) AS best_cv_adj_r2_std, round(cv_r2_mean, 4) AS best_cv_r2_mean, "
          "round(cv_rmse_mean, 4) AS best_cv_rmse_mean, round(cv_rmse_std, 4) AS best_cv_rmse_std, "
          "round(cv_mae_mean, 4) AS best_cv_mae_mean FROM trials WHERE trial_number = 7 AND model_type = 'rf' "
          "ORDER BY start_time DESC, run_id DESC LIMIT 1")
def q_best_trial(spark, sf):
    return M.best_trial(S.trials(spark, sf), 7, "rf")


@register("session_best", lambda: with_listings(S.TRIALS_SQL) +
          "SELECT model_type, best_score FROM (SELECT model_type, max(cv_adj_r2_mean) AS best_score FROM trials "
          "GROUP BY model_type) ORDER BY best_score DESC, CASE model_type WHEN 'rf' THEN 0 ELSE 1 END LIMIT 1")
def q_session_best(spark, sf):
    return M.session_best(S.trials(spark, sf), ["rf", "gbt"])


PROMOTE_SQL = ("dec AS (SELECT version, model_type, round(cv_adj_r2, 4) AS cv_adj_r2, inc AS incumbent_score, "
               "(inc IS NULL OR round(cv_adj_r2, 4) > inc) AS promoted FROM (SELECT *, max(round(cv_adj_r2, 4)) "
               "OVER (ORDER BY version ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS inc FROM versions))")


@register("promote_champion", lambda: with_listings(S.VERSIONS_SQL, PROMOTE_SQL) +
          "SELECT *, CASE WHEN promoted THEN 'champion' ELSE 'challenger' END AS status_at_registration FROM dec")
def q_promote_champion(spark, sf):
    return M.promote(S.versions(spark, sf), bucket_width=1000)


ALIAS_SQL = ("al AS (SELECT 'champion' AS alias, (SELECT max(version) FROM dec WHERE promoted) AS version "
             "UNION ALL SELECT 'previous_champion', CASE WHEN (SELECT incumbent_score IS NOT NULL FROM dec WHERE "
             "version = (SELECT max(version) FROM dec WHERE promoted)) THEN (SELECT max(version) FROM dec WHERE "
             "promoted AND version < (SELECT max(version) FROM dec WHERE promoted)) END "
             "UNION ALL SELECT 'challenger', (SELECT max(version) FROM dec WHERE NOT promoted))")


@register("find_champion", lambda: with_listings(S.VERSIONS_SQL, PROMOTE_SQL, ALIAS_SQL) +
          "SELECT al.alias, v.version, v.model_type, v.cv_adj_r2, v.run_id FROM al JOIN versions v "
          "ON al.version = v.version")
def q_find_champion(spark, sf):
    v = S.versions(spark, sf)
    al = M.aliases(M.promote(v, bucket_width=1000))
    return M.find_champion(al, v, "champion").unionByName(M.find_champion(al, v, "previous_champion")) \
        .unionByName(M.find_champion(al, v, "challenger"))


@register("version_history", lambda: with_listings(S.VERSIONS_SQL, PROMOTE_SQL, ALIAS_SQL) +
          "SELECT v.version, v.model_type, round(v.cv_adj_r2, 4) AS cv_adj_r2, COALESCE((SELECT "
          "string_agg(alias, ',' ORDER BY alias) FROM al WHERE al.version = v.version), '') AS aliases, "
          "strftime(make_timestamp(v.creation_timestamp * 1000), '%Y-%m-%d %H:%M') AS created "
          "FROM versions v ORDER BY v.version DESC LIMIT 20")
def q_version_history(spark, sf):
    v = S.versions(spark, sf)
    return M.version_history(v, M.aliases(M.promote(v, bucket_width=1000)), 20)


# ------------------------------------------------------------------ explanation tables (D, stand-in attributions)
def _standin_attributions(spark, sf):
    """Wide stand-in attributions: contribution = value - feature mean (a linear,
    unit-weight attribution); the means are ONE aggregate broadcast as one row."""
    eng, feats = _training(spark, sf)
    x = eng.select(*LISTING_KEYS, *[F.col(f"`{f}`").cast("double").alias(f) for f in feats])
    means = x.agg(*[F.avg(f"`{f}`").alias(f"__mu{i}") for i, f in enumerate(feats)])
    att = x.crossJoin(F.broadcast(means)).select(
        *LISTING_KEYS, *[(F.col(f"`{f}`") - F.col(f"__mu{i}")).alias(f) for i, f in enumerate(feats)])
    return att, feats


def _sums(spark, sf):
    """Wide group sums of the stand-in attributions and the groups."""
    att, feats = _standin_attributions(spark, sf)
    mapping = {r["feature"]: r["grp"] for r in _mapping(spark, feats).collect()}  # one row per column of the table
    return EV.group_sums(att, mapping, LISTING_KEYS, features=feats)


def _collapsed(spark, sf):
    wide, groups = _sums(spark, sf)
    return wide.unpivot(LISTING_KEYS, groups, "grp", "contribution")


def _groups_df(spark):
    return spark.createDataFrame([(g,) for g in ONE_HOT_COLUMNS], "grp string")


def _long_sql():
    num = [f"SELECT {KEYS_SQL}, sold_price AS rid_, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM fe"
           for c in NUMERIC + ["new_construction", "has_hoa", "has_garage"]]
    num[NUMERIC.index("sale_month")] = num[NUMERIC.index("sale_month")]
    dums = [f"SELECT {KEYS_SQL}, sold_price AS rid_, '{c}_' || v AS feature, CASE WHEN CAST({c} AS VARCHAR) = v THEN 1.0 ELSE 0.0 END "
            f"AS value FROM fe, (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM fe WHERE {c} IS NOT NULL "
            f"AND CAST({c} AS VARCHAR) > (SELECT min(CAST({c} AS VARCHAR)) FROM fe))" for c in ONE_HOT_COLUMNS]
    return ("lng AS (" + " UNION ALL ".join(num + dums) + "), "
            "att AS (SELECT l.* EXCLUDE (value), value - mu AS contribution FROM lng l JOIN "
            "(SELECT feature, avg(value) AS mu FROM lng GROUP BY feature) m USING (feature)), "
            "grps AS (SELECT * FROM (VALUES " + ", ".join(f"('{g}')" for g in ONE_HOT_COLUMNS) + ") t(grp)), "
            "names AS (SELECT DISTINCT feature FROM lng), "
            "mapping AS (SELECT feature, COALESCE(grp, feature) AS grp FROM (SELECT n.feature, g.grp, row_number() "
            "OVER (PARTITION BY n.feature ORDER BY length(g.grp) DESC NULLS LAST) AS r FROM names n LEFT JOIN grps g "
            "ON starts_with(n.feature, g.grp || '_')) WHERE r = 1), "
            f"col AS (SELECT {KEYS_SQL}, grp, sum(contribution) AS contribution FROM att JOIN mapping USING (feature) "
            f"GROUP BY {KEYS_SQL}, rid_, grp), "
            "imp AS (SELECT grp, avg(abs(contribution)) AS mean_abs_contribution FROM col GROUP BY grp "
            "ORDER BY mean_abs_contribution DESC, grp LIMIT 20)")


def _explain_sql(body):
    return lambda: with_cleaned(feature_ctes(), _long_sql()) + body


def _mapping(spark, feats):
    names = spark.createDataFrame([(f,) for f in feats], "feature string")
    return EV.column_to_group(names, _groups_df(spark))


@register("column_to_group", _explain_sql("SELECT feature, grp FROM mapping"))
def q_column_to_group(spark, sf):
    eng, feats = _training(spark, sf)
    return _mapping(spark, feats)


@register("collapse_groups", _explain_sql(f"SELECT {KEYS_SQL}, grp, round(contribution, 4) AS contribution FROM col"))
def q_collapse_groups(spark, sf):
    return _collapsed(spark, sf).select(*LISTING_KEYS, "grp", r4("contribution"))


@register("group_importance", _explain_sql("SELECT grp, round(mean_abs_contribution, 4) AS mean_abs_contribution FROM imp"))
def q_group_importance(spark, sf):
    g = EV.group_importance(*_sums(spark, sf), 20)
    return g.select("grp", r4("mean_abs_contribution"))


@register("attribution_rows", _explain_sql(
    f"SELECT {KEYS_SQL}, grp, round(contribution, 4) AS contribution FROM col WHERE grp IN (SELECT grp FROM imp "
    f"ORDER BY mean_abs_contribution DESC, grp LIMIT {TOP_GROUPS})"))
def q_attribution_rows(spark, sf):
    wide, groups = _sums(spark, sf)
    long = wide.unpivot(LISTING_KEYS, groups, "grp", "contribution")
    rows = EV.attribution_rows(long, EV.group_importance(wide, groups, TOP_GROUPS))
    return rows.select(*LISTING_KEYS, "grp", r4("contribution"))


# ------------------------------------------------------------------ model fits (rows-only)
@register("split_target", lambda: with_cleaned(feature_ctes()) + (
    f"SELECT {KEYS_SQL}, sold_price, CAST({len(NUMERIC) + 3} + (SELECT " + " + ".join(
        f"(SELECT greatest(count(DISTINCT {c}) - 1, 0) FROM fe)" for c in ONE_HOT_COLUMNS) + ") AS INTEGER) AS n_features FROM fe"))
def q_split_target(spark, sf):
    eng, feats = _training(spark, sf)
    y, x = M.split_target(eng, feats, keep=LISTING_KEYS)
    return y.select(*LISTING_KEYS, "sold_price", F.lit(len(x.columns)).alias("n_features"))


@register("train_forest")
def q_train_forest(spark, sf):
    eng, feats = _training(spark, sf)
    m = M.train(eng, feats, "rf")
    return m.transform(eng).select(*LISTING_KEYS, F.col("sold_price").alias("actual"),
                                   F.col("prediction").alias("predicted"))


@register("train_boosted")
def q_train_boosted(spark, sf):
    eng, feats = _training(spark, sf)
    m = M.train(eng, feats, "gbt")
    return m.transform(eng).select(*LISTING_KEYS, F.col("sold_price").alias("actual"),
                                   F.col("prediction").alias("predicted"))


@register("oof_predict")
def q_oof_predict(spark, sf):
    with scratch_scope(spark) as scope:
        eng, feats = _training(spark, sf)
        return scope.keep(M.oof_predictions(eng, feats, "rf", k=5, seed=42, key=LISTING_KEYS, keep=LISTING_KEYS, scope=scope))


_SEARCHED: dict[tuple[str, str], str] = {}


def searched(spark, sf) -> str:
    """Folder of the engineered rows and the trial table, searched once per application and table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _SEARCHED:
        eng, feats = _training(spark, sf)
        path = scratch_path(spark, "searched")
        eng.write.parquet(f"{path}/rows")
        SR.search(eng, feats, LISTING_KEYS, SEARCH, folder=path).write.parquet(f"{path}/trials")
        _SEARCHED[key] = path
    return _SEARCHED[key]


@register("random_search")
def q_random_search(spark, sf):
    return spark.read.parquet(f"{searched(spark, sf)}/trials")


@register("train_best_trial")
def q_train_best_trial(spark, sf):
    """The search's winner, fitted on the whole table."""
    path = searched(spark, sf)
    eng = spark.read.parquet(f"{path}/rows")
    m = SR.train_best(eng, FE.feature_columns(eng), spark.read.parquet(f"{path}/trials"))
    return m.transform(eng).select(*LISTING_KEYS, F.col("sold_price").alias("actual"),
                                   F.col("prediction").alias("predicted"))


@register("feature_importance")
def q_feature_importance(spark, sf):
    with scratch_scope(spark) as scope:  # the importances are rows of the driver
        eng, feats = _training(spark, sf)
        return M.feature_importance(M.train(eng, feats, "rf", scope=scope), feats, 15)


@register("save_load_model")
def q_save_load_model(spark, sf):
    eng, feats = _training(spark, sf)
    path = scratch_path(spark, "model")
    M.save_model(M.train(eng, feats, "rf"), path)
    return M.load_model(path).transform(eng).select(*LISTING_KEYS, F.col("prediction").alias("predicted"))


@register("sample_rows")
def q_sample_rows(spark, sf):
    eng, _ = _training(spark, sf)
    return EV.sample_rows(eng, 500, 42, LISTING_KEYS)


@register("tree_attribution")
def q_tree_attribution(spark, sf):
    """#71 on 500 sampled rows (the attribution sample size) of the forest that ``train_forest`` fits."""
    from homeledger.operators import attribution as A
    eng, feats = _training(spark, sf)
    model = M.train(eng, feats, "rf")
    sample = EV.sample_rows(eng, 500, 42, LISTING_KEYS)
    att = A.tree_attribution(sample, model.stages[-1], feats, LISTING_KEYS)
    return A.to_long(att, feats, LISTING_KEYS)
