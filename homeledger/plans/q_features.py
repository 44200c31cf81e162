"""Queries for filter rules (24-25) and feature engineering (20-22, 36, 38, 39, 45-52)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from homeledger.functions.columns import season_sql
from homeledger.operators import clean as C
from homeledger.operators import features as FE
from homeledger.operators import quality as Q
from homeledger.operators import rules as R
from homeledger.plans.registry import register
from homeledger.plans.sqlbits import KEYS_SQL, feature_ctes, mode_sql, with_cleaned, with_listings
from homeledger.schema import LISTING_COLUMNS, LISTING_KEYS, MEDIAN_IMPUTE_PLAN, NON_FEATURE_COLUMNS, ONE_HOT_COLUMNS
from homeledger.session import materialize, scratch_path
from homeledger.sources.fixture import listings

# Rules from the review workflow's documented examples, plus a text rule and a != rule.
RULES = ["beds>20", "sold_price<10000", "style==MULTI_FAMILY", "half_baths!=1"]
NUMERIC_FEATURES = ["sold_price", "year_built", "sqft", "beds", "full_baths", "half_baths",
                    "lot_sqft", "stories", "parking_garage", "hoa_fee", "sale_month"]


def _rule_sql(rule: str) -> str:
    from homeledger.functions.rules import parse_rule
    r = parse_rule(rule)
    v = repr(r.value) if isinstance(r.value, float) else "'" + str(r.value) + "'"
    if r.op == "!=":
        return f"({r.column} IS DISTINCT FROM {v})"
    op = "=" if r.op == "==" else r.op
    return f"COALESCE({r.column} {op} {v}, FALSE)"


@register("apply_filter_rules", lambda: with_listings() +
          f"SELECT {KEYS_SQL}, CASE WHEN {' OR '.join(_rule_sql(r) for r in RULES)} THEN 'removed' ELSE 'kept' END "
          f"AS split FROM listings")
def q_apply_filter_rules(spark, sf):
    kept, removed = R.apply_filter_rules(listings(spark, sf), RULES)
    return (kept.select(*LISTING_KEYS, F.lit("kept").alias("split"))
            .unionByName(removed.select(*LISTING_KEYS, F.lit("removed").alias("split"))))


def _rule_log_sql():
    from homeledger.functions.rules import parse_rule
    parts = []
    for i, rule in enumerate(RULES):
        r = parse_rule(rule)
        p = _rule_sql(rule)
        parts.append(
            f"SELECT {i} AS rule_id, '{rule}' AS rule, '{r.column}' AS \"column\", '{r.op}' AS operator, "
            f"'{r.value_text()}' AS value, (SELECT count(*) FROM listings WHERE {p}) AS rows_removed, "
            f"COALESCE((SELECT string_agg(v, ', ' ORDER BY rn) FROM (SELECT CAST({r.column} AS VARCHAR) AS v, "
            f"row_number() OVER (ORDER BY {KEYS_SQL}) AS rn FROM listings WHERE {p}) WHERE rn <= 10), '') "
            f"AS sample_values")
    return with_listings() + "\nUNION ALL\n".join(parts)


@register("filter_rule_log", _rule_log_sql)
def q_filter_rule_log(spark, sf):
    return R.filter_rule_log(listings(spark, sf), RULES, LISTING_KEYS)


_KEPT_AFTER_DROP = [c for c in LISTING_COLUMNS if c not in NON_FEATURE_COLUMNS]


@register("drop_unnecessary_columns", lambda: with_cleaned() + f"SELECT {', '.join(_KEPT_AFTER_DROP)} FROM cleaned")
def q_drop_unnecessary_columns(spark, sf):
    return FE.drop_unnecessary_columns(C.clean_data(listings(spark, sf)))


@register("drop_days_on_mls", lambda: with_cleaned() +
          f"SELECT {', '.join(c for c in _KEPT_AFTER_DROP if c != 'days_on_mls')} FROM cleaned")
def q_drop_days_on_mls(spark, sf):
    return FE.drop_days_on_mls(FE.drop_unnecessary_columns(C.clean_data(listings(spark, sf))))


@register("drop_null_style_city", lambda: with_listings() +
          "SELECT * FROM listings WHERE style IS NOT NULL AND city IS NOT NULL")
def q_drop_null_style_city(spark, sf):
    return FE.drop_null_style_city(listings(spark, sf))


@register("list_date_features", lambda: with_cleaned(
    "da AS (SELECT cleaned.* EXCLUDE (list_date), month(TRY_CAST(list_date AS DATE)) AS m_ FROM cleaned)",
    f"db AS (SELECT *, {season_sql('m_')} AS s_ FROM da)",
    f"dm AS (SELECT {mode_sql('m_', 'db')} AS mm, {mode_sql('s_', 'db')} AS ms)") +
    "SELECT db.* EXCLUDE (m_, s_), CAST(COALESCE(m_, mm, 6) AS INTEGER) AS sale_month, "
    "COALESCE(s_, ms, 'Summer') AS sale_season FROM db, dm")
def q_list_date_features(spark, sf):
    return FE.list_date_features(C.clean_data(listings(spark, sf)))


@register("impute_absence", lambda: with_cleaned() +
          "SELECT * REPLACE (CAST(COALESCE(half_baths, 0) AS INTEGER) AS half_baths, "
          "CAST(COALESCE(parking_garage, 0) AS INTEGER) AS parking_garage, COALESCE(hoa_fee, 0.0) AS hoa_fee), "
          "CAST(hoa_fee IS NOT NULL AS INTEGER) AS has_hoa, CAST(parking_garage IS NOT NULL AS INTEGER) AS has_garage "
          "FROM cleaned")
def q_impute_absence(spark, sf):
    return FE.impute_absence(C.clean_data(listings(spark, sf)))


@register("grouped_median_impute", lambda: with_cleaned(
    "g AS (SELECT style, median(year_built) AS gm FROM cleaned WHERE style IS NOT NULL GROUP BY style)",
    "h AS (SELECT cleaned.* REPLACE (COALESCE(CAST(cleaned.year_built AS DOUBLE), g.gm) AS year_built) "
    "FROM cleaned LEFT JOIN g ON cleaned.style = g.style)") +
    "SELECT * REPLACE (COALESCE(year_built, (SELECT median(year_built) FROM h)) AS year_built) FROM h")
def q_grouped_median_impute(spark, sf):
    return FE.grouped_median_impute(C.clean_data(listings(spark, sf)), "year_built", ["style"])


def _pre_encoded(spark, sf):
    df = C.clean_data(listings(spark, sf))
    for step in (FE.drop_unnecessary_columns, FE.drop_days_on_mls, FE.list_date_features,
                 FE.drop_null_style_city, FE.impute_absence, FE.impute_low_null):
        df = step(df)
    return df


@register("impute_low_null", lambda: with_cleaned(feature_ctes()) + "SELECT * FROM fe")
def q_impute_low_null(spark, sf):
    return _pre_encoded(spark, sf)


def _onehot_sql():
    parts = [f"SELECT {KEYS_SQL}, '{c}_' || CAST({c} AS VARCHAR) AS feature FROM fe "
             f"WHERE CAST({c} AS VARCHAR) <> (SELECT min(CAST({c} AS VARCHAR)) FROM fe)" for c in ONE_HOT_COLUMNS]
    return with_cleaned(feature_ctes()) + "\nUNION ALL\n".join(parts)


def _engineered(spark, sf):
    run = FE.FeatureRun()
    eng = FE.feature_pipeline(C.clean_data(listings(spark, sf)), run)
    return eng, run


@register("one_hot_encode", _onehot_sql)
def q_one_hot_encode(spark, sf):
    eng, run = _engineered(spark, sf)
    dums = FE.dummy_columns(run.categories)
    long = eng.select(*LISTING_KEYS, F.explode(F.array(*[
        F.when(F.col(f"`{d}`") == 1, F.lit(d)) for d in dums])).alias("feature"))
    return long.where(F.col("feature").isNotNull())


_ENG_BASE = ["sold_price", "year_built", "sqft", "beds", "full_baths", "half_baths", "new_construction",
             "lot_sqft", "stories", "parking_garage", "hoa_fee", "sale_month", "has_hoa", "has_garage"]


def _pipeline_sql():
    dummies = " + ".join(f"CASE WHEN CAST({c} AS VARCHAR) <> (SELECT min(CAST({c} AS VARCHAR)) FROM fe) "
                         f"THEN 1 ELSE 0 END" for c in ONE_HOT_COLUMNS)
    base = ", ".join(f"CAST(new_construction AS INTEGER) AS new_construction" if c == "new_construction" else c
                     for c in _ENG_BASE)
    return with_cleaned(feature_ctes()) + f"SELECT {KEYS_SQL}, {base}, {dummies} AS dummies_set FROM fe"


@register("feature_pipeline", _pipeline_sql)
def q_feature_pipeline(spark, sf):
    eng, run = _engineered(spark, sf)
    dums = FE.dummy_columns(run.categories)
    return eng.select(*LISTING_KEYS, *_ENG_BASE,
                      reduce(lambda a, b: a + b, [F.col(f"`{d}`") for d in dums]).alias("dummies_set"))


def _sparse_sql():
    parts, below = [], "0"
    for c in ONE_HOT_COLUMNS:
        parts.append(f"SELECT {KEYS_SQL}, '{c}' AS grp, CAST({below} + r - 2 AS INTEGER) AS slot FROM fe JOIN "
                     f"(SELECT v, dense_rank() OVER (ORDER BY v) AS r FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v "
                     f"FROM fe WHERE {c} IS NOT NULL)) ON CAST({c} AS VARCHAR) = v WHERE r > 1")
        below += f" + (SELECT greatest(count(DISTINCT {c}) - 1, 0) FROM fe)"
    return with_cleaned(feature_ctes()) + "\nUNION ALL\n".join(parts)


@register("sparse_encode", _sparse_sql)
def q_sparse_encode(spark, sf):
    """The set slots of the sparse vectors, by column, as rows."""
    from pyspark.ml.functions import vector_to_array

    rows = materialize(_pre_encoded(spark, sf), "pre-encoded")
    numeric = ["year_built", "sqft"]
    enc, layout = FE.sparse_encode(rows, FE.category_index(rows), numeric)
    ends, at = [], 0
    for c, n in layout[len(numeric):]:
        at += n
        ends.append((c, at))
    slot = F.col("slot")
    grp = reduce(lambda rest, e: F.when(slot < e[1], F.lit(e[0])).otherwise(rest), reversed(ends), F.lit(None))
    return (enc.select(*LISTING_KEYS, F.posexplode(F.slice(vector_to_array("features"), len(numeric) + 1, at)).alias("slot", "x"))
            .where("x = 1").select(*LISTING_KEYS, grp.alias("grp"), "slot"))


def _new_rows_sql():
    """Statistics of the cleaned rows (feature_ctes) applied to every raw listing."""
    ctes = [feature_ctes(),
            f"na AS (SELECT {KEYS_SQL}, style, sold_price, year_built, sqft, beds, full_baths, half_baths, new_construction, "
            f"city, lot_sqft, stories, parking_garage, hoa_fee, county, state, zip_code, month(TRY_CAST(list_date AS DATE)) "
            f"AS m_ FROM listings WHERE style IS NOT NULL AND city IS NOT NULL)",
            f"nb AS (SELECT *, {season_sql('m_')} AS s_ FROM na)",
            "n0 AS (SELECT nb.* EXCLUDE (m_, s_) REPLACE (CAST(COALESCE(half_baths, 0) AS INTEGER) AS half_baths, "
            "CAST(COALESCE(parking_garage, 0) AS INTEGER) AS parking_garage, COALESCE(hoa_fee, 0.0) AS hoa_fee), "
            "CAST(COALESCE(m_, mm, 6) AS INTEGER) AS sale_month, COALESCE(s_, ms, 'Summer') AS sale_season, "
            "CAST(hoa_fee IS NOT NULL AS INTEGER) AS has_hoa, CAST(parking_garage IS NOT NULL AS INTEGER) AS has_garage "
            "FROM nb, fmode)"]
    for i, (col, keys) in enumerate(MEDIAN_IMPUTE_PLAN, start=1):
        on = " AND ".join(f"n{i - 1}.{k} = g{i}.{k}" for k in keys)
        ctes.append(f"n{i} AS (SELECT n{i - 1}.* REPLACE (COALESCE(CAST(n{i - 1}.{col} AS DOUBLE), g{i}.gm, "
                    f"(SELECT median({col}) FROM h{i})) AS {col}) FROM n{i - 1} LEFT JOIN g{i} ON {on})")
    dummies = " + ".join(f"CASE WHEN CAST({c} AS VARCHAR) IN (SELECT CAST({c} AS VARCHAR) FROM fe WHERE {c} IS NOT NULL) AND "
                         f"CAST({c} AS VARCHAR) <> (SELECT min(CAST({c} AS VARCHAR)) FROM fe) THEN 1 ELSE 0 END"
                         for c in ONE_HOT_COLUMNS)
    base = ", ".join("CAST(new_construction AS INTEGER) AS new_construction" if c == "new_construction" else c for c in _ENG_BASE)
    return with_cleaned(*ctes) + f"SELECT {KEYS_SQL}, {base}, {dummies} AS dummies_set FROM n{len(MEDIAN_IMPUTE_PLAN)}"


@register("encode_new_rows", _new_rows_sql)
def q_encode_new_rows(spark, sf):
    """Fit on the cleaned listings, save, load, and encode every raw listing."""
    path = scratch_path(spark, "features-model")
    FE.ListingFeatures().fit(materialize(C.clean_data(listings(spark, sf)), "training")).save(path)
    model = FE.ListingFeaturesModel.load(path)
    eng = model.transform(listings(spark, sf))
    return eng.select(*LISTING_KEYS, *_ENG_BASE, reduce(
        lambda a, b: a + b, [F.col(f"`{d}`") for d in FE.dummy_columns(model.categories)]).alias("dummies_set"))


@register("category_dictionary", lambda: with_cleaned(feature_ctes()) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS grp, v AS value, v = min(v) OVER () AS is_baseline, "
    f"CAST(dense_rank() OVER (ORDER BY v) AS INTEGER) AS position "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM fe WHERE {c} IS NOT NULL)" for c in ONE_HOT_COLUMNS))
def q_category_dictionary(spark, sf):
    return FE.category_dictionary(_pre_encoded(spark, sf), ONE_HOT_COLUMNS)


@register("skew_report", lambda: with_cleaned() +
          "SELECT count(*) FILTER (WHERE (hoa_fee IS NOT NULL) <> COALESCE(hoa_fee > 0, FALSE)) AS has_hoa_mismatch, "
          "count(*) FILTER (WHERE (parking_garage IS NOT NULL) <> COALESCE(parking_garage > 0, FALSE)) "
          "AS has_garage_mismatch, count(*) AS rows FROM cleaned")
def q_skew_report(spark, sf):
    return FE.skew_report(C.clean_data(listings(spark, sf)))


def _delta_sql():
    n_dummy = " + ".join(f"(SELECT count(DISTINCT {c}) - 1 FROM fe)" for c in ONE_HOT_COLUMNS)
    n_eng = f"(4 + {len(_ENG_BASE)} + {n_dummy})"
    nulls = " + ".join(f"count(*) - count({c})" for c in [*LISTING_KEYS, *_ENG_BASE])  # dummies are 0 or 1
    return with_cleaned(feature_ctes()) + (
        f"SELECT CAST((SELECT {nulls} FROM fe) AS BIGINT) AS null_count_total, "
        f"(SELECT count(*) FROM fe) - (SELECT count(*) FROM cleaned) AS row_count_delta, "
        f"CAST({n_eng} - {len(LISTING_COLUMNS)} AS INTEGER) AS feature_count_delta, "
        f"CAST({n_eng} AS INTEGER) AS engineered_columns")


@register("feature_delta", _delta_sql)
def q_feature_delta(spark, sf):
    cleaned = C.clean_data(listings(spark, sf))
    eng = FE.feature_pipeline(cleaned)
    return Q.feature_delta(cleaned, eng)


@register("validity_bounds", lambda: with_cleaned(feature_ctes()) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(min({c}), 2) AS min, round(max({c}), 2) AS max, "
    f"round(quantile_cont({c}, 0.01), 2) AS p01, round(quantile_cont({c}, 0.99), 2) AS p99, "
    f"round(median({c}), 2) AS median FROM fe" for c in NUMERIC_FEATURES if c != "sold_price"))
def q_validity_bounds(spark, sf):
    eng, _ = _engineered(spark, sf)
    return Q.validity_bounds(eng, [c for c in NUMERIC_FEATURES if c != "sold_price"])


@register("validity_rules", lambda: with_cleaned(feature_ctes()) +
          "SELECT CAST(max(year_built) AS INTEGER) - 2 AS new_construction_min_year FROM fe")
def q_validity_rules(spark, sf):
    eng, _ = _engineered(spark, sf)
    return Q.validity_rules(eng)
