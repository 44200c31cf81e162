"""The commit log: what was not published is invisible, and what is published again adds nothing."""

import pytest
from pyspark.sql import functions as F

from homeledger.sources import commits as L

KEYS = ["stage", "snapshot"]


def rows(spark, *data):
    return spark.createDataFrame(list(data), "stage string, snapshot string, n long, tags array<string>")


def seen(spark, path):
    return sorted((r["stage"], r["snapshot"], r["n"]) for r in L.read(spark, path, KEYS).collect())


def test_newest_version_of_each_unit_is_read(spark, tmp_path):
    path = str(tmp_path)
    L.publish(rows(spark, ("a", "007", 1, ["x"]), ("a", "007", 1, ["x"]), ("a", "x/y=z", 2, None)), path, KEYS, "v1", "clean")
    L.publish(rows(spark, ("a", "007", 5, [])), path, KEYS, "v2", "clean")
    assert seen(spark, path) == [("a", "007", 5), ("a", "x/y=z", 2)]
    now = {(r["snapshot"], r["version"], r["rows"], r["files"], r["step"]) for r in L.manifest(spark, path, KEYS).collect()}
    assert now == {("007", "v2", 1, 1, "clean"), ("x/y=z", "v1", 1, 1, "clean")}
    assert L.history(spark, path).count() == 3
    assert [tuple(r) for r in L.read_unit(spark, path, {"stage": "a", "snapshot": "007"}).collect()] == [("a", "007", 5, [])]
    only = rows(spark, ("a", "x/y=z", 0, None))
    assert [r["n"] for r in L.read(spark, path, KEYS, only).collect()] == [2]
    with pytest.raises(FileNotFoundError):
        L.read_unit(spark, path, {"stage": "a", "snapshot": "7"})


def test_a_rerun_under_its_name_adds_nothing(spark, tmp_path):
    path = str(tmp_path)
    for n in (1, 1, 9):  # the third has other rows, but its version is committed already
        assert L.publish(rows(spark, ("a", "s", n, None)), path, KEYS, "run-1") == "run-1"
    assert seen(spark, path) == [("a", "s", 1)] and L.commits(spark, path).count() == 1
    L.publish(rows(spark, ("a", "s", 2, None)), path, KEYS)  # without a name: a new version replaces the unit
    assert seen(spark, path) == [("a", "s", 2)] and L.commits(spark, path).agg(F.max("number")).first()[0] == 2


@pytest.mark.parametrize("killed_after", ["data", "manifest"])
def test_a_half_written_version_is_invisible_and_starts_afresh(spark, tmp_path, monkeypatch, killed_after):
    path = str(tmp_path)
    L.publish(rows(spark, ("a", "s", 1, None)), path, KEYS, "v1")
    with monkeypatch.context() as m:
        if killed_after == "data":
            m.setattr(L, "dataset_fingerprint", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        else:
            m.setattr(L.F, "current_timestamp", lambda: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            L.publish(rows(spark, ("a", "s", 2, None), ("b", "t", 3, None), ("b", "u", 3, None)), path, KEYS, "v2")
    assert spark.read.parquet(f"{path}/data/version=v2").count() == 3  # its files are there
    assert seen(spark, path) == [("a", "s", 1)]
    assert L.newest_unit(spark, path, KEYS) == {"stage": "a", "snapshot": "s"}
    # started again with fewer rows: nothing of the killed run is left
    L.publish(rows(spark, ("b", "t", 4, None)), path, KEYS, "v2")
    assert seen(spark, path) == [("a", "s", 1), ("b", "t", 4)]
    assert L.newest_unit(spark, path, KEYS) == {"stage": "b", "snapshot": "t"}
    assert L.newest_unit(spark, path, KEYS, stage="a") == {"stage": "a", "snapshot": "s"}


def test_equal_numbers_go_to_the_later_version_name(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    with monkeypatch.context() as m:  # two jobs that both saw an empty log
        empty = spark.createDataFrame([], L.COMMIT_SCHEMA)
        m.setattr(L, "commits", lambda *_: empty)
        for v, n in (("v2", 2), ("v1", 1)):
            L.publish(rows(spark, ("a", "s", n, None), ("a", v, n, None)), path, KEYS, v)
    assert seen(spark, path) == [("a", "s", 2), ("a", "v1", 1), ("a", "v2", 2)]


def test_lost_files_are_found(spark, tmp_path):
    path = str(tmp_path)
    v = L.publish(rows(spark, ("a", "s", 1, None), ("a", "t", 2, ["q"]), ("a", "t", 2, None)), path, KEYS)
    assert L.damaged(spark, path, KEYS).count() == 0
    rows(spark, ("a", "t", 7, None)).drop("stage", "snapshot").write.mode("append").parquet(
        f"{path}/data/version={v}/stage=a/snapshot=t")
    assert [tuple(r) for r in L.damaged(spark, path, KEYS).collect()] == [("a", "t", 2, 3)]


def test_edges(spark, tmp_path):
    path = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        L.read(spark, path, KEYS)
    L.publish(rows(spark).limit(0), path, KEYS, "none")
    assert seen(spark, path) == [] and L.manifest(spark, path, KEYS).count() == 0
    with pytest.raises(FileNotFoundError):
        L.newest_unit(spark, path, KEYS)
    for bad in (None, ""):
        with pytest.raises(Exception, match="has no snapshot"):
            L.publish(rows(spark, ("a", bad, 1, None)), path, KEYS, "bad")
    with pytest.raises(ValueError, match="version"):
        L.publish(rows(spark).withColumn("version", F.lit(1)), path, KEYS)
    assert seen(spark, path) == []
    L.publish(rows(spark, ("a", "s", 1, None)), path, KEYS)
    L.publish(rows(spark, ("a", "t", 2, None)).withColumn("more", F.lit("m")), path, KEYS)  # a newer column
    assert sorted((r["n"], r["more"]) for r in L.read(spark, path, KEYS).collect()) == [(1, None), (2, "m")]


def test_json_rows_and_broken_records(spark, tmp_path):
    path = str(tmp_path)
    v = L.publish(rows(spark, ("a", "s", 1, ["p", "q"])), path, KEYS, fmt="json")
    spark.createDataFrame([("{not json",)], "value string").write.mode("append").text(
        f"{path}/data/version={v}/stage=a/snapshot=s")
    spark.createDataFrame([("{not json",)], "value string").write.mode("append").text(f"{path}/data/version=other/stage=a/snapshot=s")
    assert [tuple(r) for r in L.read(spark, path, KEYS).collect()] == [("a", "s", 1, ["p", "q"])]
