"""The engineered snapshot holds filled rows; readers make the dummies."""

import pytest
from pyspark.sql import functions as F

from homeledger.operators import clean as C
from homeledger.operators import features as FE
from homeledger.sources.fixture import listings

SF = "/root/testdata/sf0.001"


def test_f22_stored_rows_hold_no_dummies(spark):
    run = FE.FeatureRun()
    cleaned = C.clean_data(listings(spark, SF))
    eng = FE.feature_pipeline(cleaned, run)
    stored = spark.read.parquet(*eng.inputFiles())
    dummies = FE.dummy_columns(run.categories)
    assert dummies and not set(dummies) & set(stored.columns) and set(dummies) <= set(eng.columns)
    want = run.model.transform(cleaned)
    assert eng.columns == want.columns and eng.exceptAll(want).isEmpty() and eng.count() == want.count()


def test_f22_a_missing_flag_raises_when_the_rows_are_written(spark):
    bad = C.clean_data(listings(spark, SF)).withColumn("new_construction", F.lit(None).cast("boolean"))
    with pytest.raises(Exception, match="new_construction has a missing value"):
        FE.feature_pipeline(bad)
