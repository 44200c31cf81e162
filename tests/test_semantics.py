"""Hand-made rows for the semantic decisions N1-N27."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T


def df_of(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_not_equal_rule_removes_missing(spark):
    from homeledger.operators.rules import apply_filter_rules
    d = df_of(spark, [(1, 2.0), (2, None), (3, 1.0)], "id int, half_baths double")
    kept, removed = apply_filter_rules(d, ["half_baths!=1"])
    assert sorted(r.id for r in removed.collect()) == [1, 2]
    kept2, removed2 = apply_filter_rules(d, ["half_baths>1"])
    assert sorted(r.id for r in removed2.collect()) == [1]
    assert kept2.count() + removed2.count() == d.count()


def test_bad_rule_and_unknown_column_raise(spark):
    from homeledger.functions.rules import parse_rule
    from homeledger.operators.rules import apply_filter_rules
    with pytest.raises(ValueError):
        parse_rule("beds 2")
    d = df_of(spark, [(1,)], "beds int")
    with pytest.raises(ValueError):
        apply_filter_rules(d, ["baths>2"])
    r = parse_rule("style=='CONDO'")
    assert r.value == "CONDO" and r.op == "=="


def test_iqr_inclusive_null_passes_same_input(spark):
    from homeledger.operators.clean import remove_outliers_iqr
    rows = [(float(v), 1.0) for v in [1, 2, 3, 4, 100]] + [(None, 1.0)]
    d = df_of(spark, rows, "sold_price double, sqft double")
    out = remove_outliers_iqr(d, ["sold_price", "sqft"])
    vals = sorted([r.sold_price for r in out.collect()], key=lambda x: (x is None, x))
    # q1=2, q3=4, iqr=2 -> [-1, 7]; 100 is out, null passes
    assert vals == [1.0, 2.0, 3.0, 4.0, None]


def test_dedup_null_equals_null(spark):
    from homeledger.operators.clean import deduplicate
    d = df_of(spark, [(1, None), (1, None), (2, "a")], "a int, b string")
    assert deduplicate(d).count() == 2


def test_dedup_skips_nested_columns_with_order(spark):
    from homeledger.operators.clean import deduplicate
    d = df_of(spark, [(1, [1], 0), (1, [2], 1)], "a int, tags array<int>, pos int")
    with pytest.raises(ValueError):
        deduplicate(d.drop("pos"))
    out = deduplicate(d.select("a", "tags"), order_by=[F.col("a")])
    assert out.count() == 1


def test_mode_tie_picks_smallest_and_default(spark):
    from homeledger.operators.features import list_date_features
    d = df_of(spark, [("2020-03-01",), ("2020-01-05",), ("bad",)], "list_date string")
    out = list_date_features(d).collect()
    assert sorted(r.sale_month for r in out) == [1, 1, 3]
    # seasons tie Winter/Spring -> 'Spring' (alphabetically first)
    assert [r.sale_season for r in out].count("Spring") == 2
    empty = df_of(spark, [("bad",)], "list_date string")
    r = list_date_features(empty).collect()[0]
    assert (r.sale_month, r.sale_season) == (6, "Summer")


def test_group_median_null_key_uses_global(spark):
    from homeledger.operators.features import grouped_median_impute
    d = df_of(spark, [("A", 1.0), ("A", 3.0), ("A", None), ("B", None), (None, None), ("C", 10.0)],
              "style string, beds double")
    out = {(r.style, i): r.beds for i, r in enumerate(grouped_median_impute(d, "beds", ["style"]).collect())}
    vals = sorted(v for v in out.values())
    # A null -> 2; B (all null) and null style -> global median of filled [1,3,2,10] = 2.5
    assert vals == [1.0, 2.0, 2.5, 2.5, 3.0, 10.0]


def test_impute_batches_preserve_order():
    from homeledger.operators.features import impute_batches
    from homeledger.schema import MEDIAN_IMPUTE_PLAN
    cols = [c for c, _ in MEDIAN_IMPUTE_PLAN] + ["style"]
    b = impute_batches(MEDIAN_IMPUTE_PLAN, cols)
    assert b == [(["year_built", "beds", "stories", "lot_sqft"], ["style"]),
                 (["sqft", "full_baths"], ["style", "beds"])]
    # a step that fills a key used earlier may not move before that user
    plan = [("a", ["k"]), ("k", ["s"]), ("b", ["k"])]
    assert impute_batches(plan, ["a", "b", "k", "s"]) == [(["a"], ["k"]), (["k"], ["s"]), (["b"], ["k"])]


def test_one_hot_drop_first_null_zero_single_vanishes(spark):
    from homeledger.operators.features import one_hot_encode
    d = df_of(spark, [("b", "OH", True), ("a", "OH", False), (None, "OH", False), ("c", "OH", True)],
              "style string, state string, new_construction boolean")
    out, cats = one_hot_encode(d, columns=["style", "state"])
    assert out.columns == ["new_construction", "style_b", "style_c"]
    rows = out.collect()
    assert [r.style_b + r.style_c for r in rows] == [1, 0, 0, 1]
    assert cats["style"] == ["a", "b", "c"]


def test_fingerprint_order_free_and_counts_repeats(spark):
    from homeledger.operators.quality import dataset_fingerprint
    d = df_of(spark, [(1, "a"), (2, "b"), (3, None)], "x int, y string")
    f1 = dataset_fingerprint(d).collect()[0]
    f2 = dataset_fingerprint(d.orderBy(F.desc("x")).repartition(3)).collect()[0]
    f3 = dataset_fingerprint(d.union(d.limit(1))).collect()[0]
    assert f1 == f2 and f1.fingerprint != f3.fingerprint
    f4 = dataset_fingerprint(d.withColumn("y", F.lit("z"))).collect()[0]
    assert f4.fingerprint != f1.fingerprint


def test_suite_mostly_and_missing_column(spark):
    from homeledger.operators.quality import Expectation, NOT_NULL, BETWEEN, evaluate_suite
    d = df_of(spark, [(1.0,), (None,), (50.0,)], "beds double")
    suite = [Expectation(NOT_NULL, "beds", mostly=0.6), Expectation(BETWEEN, "beds", 0, 8, mostly=1.0),
             Expectation(BETWEEN, "beds", 0, 8, mostly=0.5), Expectation(NOT_NULL, "sqft", mostly=0.1)]
    res = {r.ordinal: r for r in evaluate_suite(d, suite).collect()}
    assert res[0].success and abs(res[0].observed - 2 / 3) < 1e-6
    assert not res[1].success and res[2].success
    assert not res[3].success and res[3].observed is None


def test_snapshot_names(spark):
    from homeledger.sources.io import snapshot_label, stage_name
    d = df_of(spark, [("Cincinnati, OH", 365), ("New York, NY", 90)], "loc string, days int")
    out = d.select(snapshot_label(F.col("loc"), F.col("days"), F.lit("20250414_183022")).alias("n")).collect()
    assert [r.n for r in out] == ["Cincinnati_OH_365d_20250414_183022", "New_York_NY_90d_20250414_183022"]
    d2 = df_of(spark, [("quarantined_Cincinnati_OH_365d_1",), ("fixed_quarantined_x",)], "n string")
    out2 = [r.m for r in d2.select(stage_name("approved", F.col("n")).alias("m")).collect()]
    assert out2 == ["approved_Cincinnati_OH_365d_1", "approved_quarantined_x"]


def test_name_rule_schema(spark):
    from homeledger.operators.score import infer_feature_schema
    names = ["year_built", "sqft", "beds", "full_baths", "half_baths", "lot_sqft", "stories", "parking_garage",
             "hoa_fee", "new_construction", "sale_month", "has_hoa", "has_garage", "style_CONDO", "style_TOWNHOMES",
             "city_Anderson Township", "city_Cincinnati", "zip_code_45208", "zip_code_45230",
             "county_Hamilton", "county_Warren", "sale_season_Spring", "sale_season_Summer"]
    s = infer_feature_schema(spark, names)
    assert s.categorical_groups == {"zip_code": ["45208", "45230"], "style": ["CONDO", "TOWNHOMES"],
                                    "county": ["Hamilton", "Warren"], "city": ["Anderson Township", "Cincinnati"]} \
        or set(s.categorical_groups) == {"zip_code", "style", "county", "city"}
    assert s.auto_categorical_groups == {"sale_season": ["Spring", "Summer"]}
    assert s.auto_derived["has_hoa"] == {"derived_from": "hoa_fee", "rule": "greater_than_zero"}
    assert s.auto_derived["has_garage"] == {"derived_from": "parking_garage", "rule": "greater_than_zero"}
    assert s.binary_features == ["new_construction"]
    assert "full_baths" in s.numeric_features and s.numeric_defaults["sqft"] == 1500.0
