"""Fitted feature statistics, one counting pass, and sparse encoding."""

import math

import pytest
from pyspark.sql import functions as F

from homeledger.operators import features as FE


def _rows(spark):
    """Groups with gaps, a null group, a group without any value, ties, and a key that is itself imputed."""
    return spark.range(3000).select(
        F.col("id").alias("k"),
        F.expr("CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 'a' WHEN id % 1000 = 1 THEN 'empty' ELSE 'b' END").alias("style"),
        F.expr("CASE WHEN id % 1000 = 1 OR id % 7 = 0 THEN NULL ELSE cast(id % 5 AS int) END").alias("beds"),
        F.expr("CASE WHEN id % 4 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') ELSE id * 37 % 1009 + 0.5 END").alias("sqft"))


def _one_at_a_time(pdf, plan):
    out = pdf.copy()
    for col, keys in plan:
        out[col] = out[col].astype(float).fillna(out.groupby(keys)[col].transform("median"))
        out[col] = out[col].fillna(out[col].median())
    return out


PLAN = [("beds", ["style"]), ("sqft", ["style", "beds"])]


def test_one_count_gives_the_medians_of_the_steps_in_turn(spark, monkeypatch):
    import homeledger.functions.quantiles as Q

    written = []
    plain = Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df, name: (written.append(name), plain(df, name))[1])
    df = _rows(spark)
    got = FE.impute_low_null(df, PLAN).toPandas().sort_values("k").reset_index(drop=True)
    assert written == ["value-counts"]
    want = _one_at_a_time(df.toPandas().sort_values("k").reset_index(drop=True), PLAN)
    for c in ("beds", "sqft"):
        assert (got[c] - want[c]).abs().max() < 1e-9 and got[c].notna().all()


def test_medians_of_nothing(spark):
    none = _rows(spark).withColumn("sqft", F.lit(None).cast("double"))
    got = FE.impute_low_null(none, PLAN)
    assert got.where("sqft IS NOT NULL").count() == 0 and got.where("beds IS NULL").count() == 0
    assert FE.impute_low_null(none.where("k < 0"), PLAN).count() == 0


def _listing(spark, rows):
    cols = ("k long, style string, city string, list_date string, hoa_fee double, half_baths int, parking_garage int, "
            "new_construction boolean, beds int, sqft double, state string")
    return spark.createDataFrame(rows, cols)


TRAIN = [(1, "a", "x", "2024-01-05", 5.0, None, 1, True, 3, 100.0, "OH"), (2, "a", "y", "2024-01-09", None, 1, None, False, None, 300.0, "OH"),
         (3, "b", "x", None, None, 1, 2, False, 2, None, "OH"), (4, "b", "z", "2024-07-01", 0.0, 0, 2, True, 4, 50.0, "OH")]


def _fit(spark):
    return FE.ListingFeatures(PLAN, ["style", "city", "state", "sale_season"]).fit(_listing(spark, TRAIN))


def test_loaded_model_encodes_like_the_fitted_one(spark, tmp_path):
    model = _fit(spark)
    for _ in range(2):  # the second time over the first
        model.write().overwrite().save(str(tmp_path / "m"))
    loaded = FE.ListingFeaturesModel.load(str(tmp_path / "m"))
    assert (loaded.modes, loaded.categories, loaded.columns) == (model.modes, model.categories, model.columns)
    train = _listing(spark, TRAIN)
    assert model.transform(train).exceptAll(loaded.transform(train)).count() == 0
    new = _listing(spark, [(9, "c", "q", None, None, None, None, True, None, None, None), (10, None, "x", None, None, None, None, True, 1, 1.0, "OH"),
                           (11, "b", "z", "2024-10-10", None, None, None, False, 7, None, "PA")])
    got = {r["k"]: r.asDict() for r in loaded.transform(new).collect()}
    assert set(got) == {9, 11}  # no style: dropped, as in training
    # unknown style: overall medians, saved modes, no dummy set
    overall = {c: v for b in model.medians for c, v in b.overall.items()}
    assert (got[9]["beds"], got[9]["sqft"], got[9]["sale_month"]) == (overall["beds"], overall["sqft"], 1)
    assert all(got[9][d] == 0 for d in FE.dummy_columns(model.categories) if not d.startswith("sale_season"))
    assert got[11]["city_z"] == 1 and got[11]["style_b"] == 1
    assert "state_PA" not in got[11] and "state_OH" not in got[11]


def test_missing_new_construction_raises(spark):
    model = _fit(spark)
    bad = _listing(spark, [(1, "a", "x", None, None, None, None, None, 1, 1.0, "OH")])
    with pytest.raises(Exception, match="new_construction has a missing value"):
        model.transform(bad).collect()


def test_sparse_encoding_equals_dummies(spark):
    df = _listing(spark, TRAIN).unionByName(_listing(spark, [(5, None, "x", None, None, None, None, True, 1, 2.0, None)])).fillna({"sqft": 0.0})
    cols = ["style", "city", "state"]
    dense, cats = FE.one_hot_encode(df.select("k", "sqft", *cols), columns=cols)
    sparse, layout = FE.sparse_encode(df.select("k", "sqft", *cols), FE.category_index(df, cols), ["sqft"], cols)
    assert layout == [("sqft", 1), ("style", 1), ("city", 2)]  # one state only: no slot
    want = {r["k"]: [r["sqft"], *[float(r[d]) for d in FE.dummy_columns(cats)]] for r in dense.collect()}
    assert {r["k"]: r["features"].toArray().tolist() for r in sparse.collect()} == want
    none = df.where("k < 0")
    assert FE.sparse_encode(none, FE.category_index(none, cols), ["sqft"], cols)[1] == [("sqft", 1)]


def test_hundred_thousand_categories(spark):
    df = spark.range(150_000).select(F.col("id").alias("k"), F.format_string("c%06d", F.col("id") % 100_000).alias("city"),
                                     F.lit(1.0).alias("sqft"))
    index = FE.category_index(df, ["city"])
    assert index.count() == 100_000
    enc, layout = FE.sparse_encode(df, index, ["sqft"], ["city"])
    assert layout[-1] == ("city", 99_999)
    assert len(enc._jdf.queryExecution().optimizedPlan().toString()) < 100_000  # the plan lists no values
    for r in enc.where("k IN (0, 1, 99999, 100001, 149999)").collect():
        p = r["k"] % 100_000
        assert r["features"].indices.tolist() == ([0, p] if p else [0]) and math.isclose(r["features"].norm(1), 1 + (p > 0))
