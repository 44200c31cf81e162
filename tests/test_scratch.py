"""Scratch tables and shuffle files go as soon as nothing reads them; deduplication shuffles hashes, not rows."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from homeledger.operators import clean as C
from homeledger.operators import model as M
from homeledger.session import ensure_checkpoint_dir, materialize, scratch_scope
from tests.conftest import SF_SMALL


def tables(spark, *names):
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sorted(p for n in names for p in glob.glob(f"{base}/{n}-*"))


STEPS = ["clean-filtered", "features-input", "engineered", "fit-rows", "value-counts", "group-medians"]


def test_scope_removes_what_nothing_reads(spark):
    had = tables(spark, "scope-a", "scope-b", "scope-c")
    left = lambda name: [p for p in tables(spark, name) if p not in had]
    with scratch_scope(spark) as scope:
        a = materialize(spark.range(5), "scope-a")
        b = scope.keep(materialize(a.withColumn("x", F.col("id") + 1), "scope-b"))
    assert b.count() == 5 and not left("scope-a") and len(left("scope-b")) == 1
    with pytest.raises(ValueError), scratch_scope(spark):
        materialize(spark.range(5), "scope-c")
        raise ValueError
    assert len(left("scope-c")) == 1


def test_f11_importances_leave_no_rows_behind(spark):
    before = tables(spark, *STEPS)
    assert E.queries()["feature_importance"](spark, SF_SMALL).count() == 15
    assert tables(spark, *STEPS) == before


def test_f6_folds_keep_their_rows_alone(spark):
    before = tables(spark, *STEPS)
    got = E.queries()["oof_predict"](spark, SF_SMALL)
    assert tables(spark, *STEPS) == before and got.where("predicted IS NULL").count() == 0


def test_f7_f9_f10_scorer_leaves_no_rows_behind(spark, monkeypatch):
    from homeledger.plans import q_score
    monkeypatch.setattr(q_score, "_FITTED", {})
    before = tables(spark, *STEPS)
    q_score.fitted(spark, SF_SMALL)
    assert tables(spark, *STEPS) == before
    assert E.queries()["score_batch"](spark, SF_SMALL).where("status_code = 200").count() > 0


def test_f14_snapshot_leaves_only_the_store(spark):
    before = tables(spark, *STEPS)
    got = E.queries()["latest_snapshot"](spark, SF_SMALL)
    assert tables(spark, *STEPS) == before and got.count() > 0


def test_written_table_drops_its_shuffles(spark):
    local = [d for d in glob.glob("/tmp/blockmgr-*") + glob.glob(f"{spark.conf.get('spark.local.dir', '/tmp')}/blockmgr-*")
             if os.access(d, os.R_OK)]
    found = lambda: {f for d in local for f in glob.glob(f"{d}/*/shuffle_*")}
    before = found()
    materialize(spark.range(1000).repartition(7, "id"), "scope-shuffled")
    assert not found() - before


def test_deduplicate_compares_rows_whose_hash_repeats(spark, monkeypatch):
    rows = [(1, "a", None, 0.5), (1, "a", None, 0.5), (2, None, None, 0.0), (2, None, None, -0.0), (3, "c", True, float("nan")),
            (3, "c", True, float("nan")), (4, None, None, None), (None, None, None, None), (None, None, None, None), (5, "", False, 1.0)]
    df = spark.createDataFrame(rows, "a int, b string, c boolean, d double")
    want = sorted(map(str, df.dropDuplicates().collect()))
    assert len(want) == 6
    assert sorted(map(str, C.deduplicate(df).collect())) == want
    # rows that only share a hash are kept apart
    plain = F.xxhash64
    monkeypatch.setattr(C.F, "xxhash64", lambda *c: plain(F.lit(1)))
    assert sorted(map(str, C.deduplicate(df).collect())) == want
    monkeypatch.setattr(C.F, "xxhash64", plain)
    monkeypatch.setattr(C, "MOST_REPEATED", 0)
    assert sorted(map(str, C.deduplicate(df).collect())) == want


def test_rows_without_repeats_are_not_shuffled(spark):
    out = C.deduplicate(spark.range(100).withColumn("x", F.col("id") % 7))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString() and out.count() == 100


def test_fit_rows_go_with_the_fit(spark):
    df = spark.range(300).select((F.col("id") % 10).cast("double").alias("a"), (F.col("id") * 1.0).alias("sold_price"))
    before = tables(spark, "fit-rows")
    m = M.train(df, ["a"], "gbt", {"maxIter": 2})
    assert tables(spark, "fit-rows") == before and m.transform(df).count() == 300


def test_rows_of_earlier_steps_go_before_the_fit(spark, monkeypatch):
    seen, plain = [], M.estimator
    monkeypatch.setattr(M, "estimator", lambda *a: (seen.append(tables(spark, *STEPS)), plain(*a))[1])
    before = tables(spark, *STEPS)
    E.queries()["feature_importance"](spark, SF_SMALL)
    assert len(seen) == 1 and len(set(seen[0]) - set(before)) == 1 and "fit-rows" in (set(seen[0]) - set(before)).pop()


def test_filtered_table_is_not_copied(spark):
    from homeledger.operators import features as FE
    from homeledger.session import is_filtered_table
    from homeledger.sources.fixture import listings
    rows = C.clean_data(listings(spark, SF_SMALL))
    assert is_filtered_table(rows) and not is_filtered_table(rows.dropDuplicates())
    assert not is_filtered_table(rows.unionByName(rows)) and not is_filtered_table(spark.range(3))
    before = tables(spark, "features-input")
    assert FE.feature_pipeline(rows).count() == FE.feature_pipeline(rows.dropDuplicates()).count()
    assert tables(spark, "features-input") == before
