"""The cleaning log counted by the jobs that write the rows."""

from pyspark.sql import functions as F

from homeledger.operators import clean as C
from homeledger.sources.fixture import listings
from tests.conftest import SF_SMALL


def counted(df):
    """Each step counted by an action of its own."""
    s = C.clean_steps(df)
    n = {k: v.count() for k, v in s.items()}
    return [n["raw"], n["raw"] - n["non_empty"], n["non_empty"] - n["deduplicated"], n["deduplicated"] - n["with_target"],
            n["with_target"] - n["style_filtered"], n["style_filtered"] - n["cleaned"], n["cleaned"]]


def observed(df):
    steps, log = C.clean_observed(df)
    r = log.first()
    return steps, [r.raw_rows, r.empty_rows_dropped, r.duplicates_dropped, r.missing_target_dropped,
                   r.style_filter_dropped, r.outliers_dropped, r.cleaned_rows]


def test_log_equals_separate_counts(spark):
    df = listings(spark, SF_SMALL)
    nothing = df.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]).limit(300)
    df = df.unionByName(nothing).unionByName(df.limit(50))
    steps, log = observed(df)
    assert log == counted(df) and log[1] >= 300 and log[2] >= 50
    own = steps["cleaned"]
    assert own.columns == df.columns and own.count() == log[-1]
    assert own.exceptAll(C.clean_data(df)).count() == 0


def test_empty_tables(spark):
    df = listings(spark, SF_SMALL)
    steps, log = observed(df.where("l_orderkey < 0"))
    assert log == [0] * 7 and steps["cleaned"].count() == 0
    steps, log = observed(spark.createDataFrame([], df.schema))
    assert log == [0] * 7 and steps["cleaned"].columns == df.columns
