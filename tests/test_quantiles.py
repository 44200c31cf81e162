"""Counted quantiles equal Spark's exact percentile: ties, NaN, nulls, a hot group, text values."""

from pyspark.sql import functions as F

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def _close(got, want):
    return all(abs(x - y) <= 1e-9 * max(1.0, abs(y)) for x, y in zip(got, want))


def _table(spark):
    # group 0 holds about two thirds of the rows; b has five values only
    return spark.range(0, 20000).select(
        (F.rand(7) * 1e6).alias("a"), F.floor(F.rand(3) * 5).alias("b"),
        F.when(F.rand(5) < 0.1, None).when(F.rand(9) < 0.1, float("nan")).otherwise(F.randn(2)).alias("c"),
        F.lit(None).cast("double").alias("d"),
        F.when(F.rand(1) < 0.66, 0).when(F.rand(4) < 0.1, None).otherwise(F.floor(F.rand(2) * 9)).alias("g"))


def test_whole_table(spark):
    from homeledger.functions.quantiles import exact_quantiles
    df = _table(spark)
    got = exact_quantiles(df, ["a", "b", "c", "d"], PROBS).first()
    clean = df.withColumn("c", F.when(~F.isnan("c"), F.col("c")))
    ref = clean.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in PROBS])).alias(c) for c in "abc"]).first()
    for c in "abc":
        assert _close(got[f"__q_{c}"], ref[c]), c
    assert got["__q_d"] is None


def test_groups(spark):
    from homeledger.functions.quantiles import exact_quantiles
    df = _table(spark)
    got = {r["g"]: r for r in exact_quantiles(df, ["a", "b"], [0.5, 0.9], by=["g"]).collect()}
    ref = (df.where("g IS NOT NULL").groupBy("g")
           .agg(*[F.percentile(c, F.array(F.lit(0.5), F.lit(0.9))).alias(c) for c in "ab"]).collect())
    assert set(got) == {r["g"] for r in ref}
    for r in ref:
        for c in "ab":
            assert _close(got[r["g"]][f"__q_{c}"], r[c])


def test_empty_and_text(spark):
    from homeledger.functions.quantiles import exact_quantiles
    text = spark.createDataFrame([("1",), ("x",), ("3",), (None,)], "v string")
    assert exact_quantiles(text, ["v"], [0.5]).first()["__q_v"] == [2.0]
    none = text.where("v = 'absent'")
    assert exact_quantiles(none, ["v"], [0.5]).first()["__q_v"] is None
    assert exact_quantiles(none.withColumn("g", F.lit(1)), ["v"], [0.5], by=["g"]).count() == 0


def test_no_percentile_in_plans(spark):
    from homeledger.operators.clean import outlier_report
    plan = outlier_report(_table(spark).selectExpr("a AS sold_price", "b AS sqft"), ["sold_price", "sqft"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in text and "median" not in text
