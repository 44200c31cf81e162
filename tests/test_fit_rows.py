"""Training rows in small partitions, fits one after another where they are large, folds made by the reader."""

import pytest
from pyspark.sql import functions as F

from homeledger.operators import model as M
from homeledger.operators import search as S


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(0, 9000, 1, 2).select((F.col("id") % 10).cast("double").alias("a"), F.rand(3).alias("b"))
    return df.withColumn("sold_price", F.col("a") * 100 + F.col("b"))


def test_f5_partitions_of_a_fit_grow_with_its_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "PARTITION_BYTES", 1000 * M.binned_bytes(2))
    stored = M.fit_rows(M._assembler(["a", "b"]).transform(rows).select("sold_price", "features"), 2)
    sizes = [r["count"] for r in stored.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 1000 and sum(sizes) == 9000
    m = M.train(rows, ["a", "b"], "rf", {"numTrees": 2, "maxDepth": 3})
    assert len(m.stages) == 2 and m.transform(rows).count() == 9000


def test_f1_fits_of_large_tables_follow_one_another(rows, monkeypatch):
    assert M.fits_at_a_time(rows, 2, 5) == 5
    monkeypatch.setattr(M, "PARALLEL_BYTES", 2 * 9000 * M.binned_bytes(2))
    assert M.fits_at_a_time(rows, 2, 5) == 2
    monkeypatch.setattr(M, "PARALLEL_BYTES", 1)
    assert M.fits_at_a_time(rows, 2, 5) == 1


def test_f1_folds_are_made_by_the_reader(spark, rows):
    keyed = rows.withColumn("id", F.monotonically_increasing_id())
    folder = S.scratch_path(spark, "prepared")
    read = S.prepare(keyed, ["a", "b"], ["id"], 3, 42, folder)
    assert not {"fold", S.HELD} & set(spark.read.parquet(f"{folder}/rows-assembled").columns)
    want = M.with_folds(read.select("id"), 3, 42, ["id"])
    assert read.select("id", "fold").exceptAll(want).isEmpty() and read.where(S.HELD).count() > 500
