"""Streaming runs give the same verdicts and scores as the batch operators."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL


def test_validate_and_route_stream(spark, tmp_path):
    from homeledger.operators import review as RV
    from homeledger.plans.q_review import _label
    from homeledger.sources.fixture import listings
    from homeledger.streaming import validate_and_route_stream
    src = str(tmp_path / "in")
    snaps = _label(listings(spark, SF_SMALL))
    snaps.write.partitionBy("county").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = validate_and_route_stream(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), "2025-01-01T00:00:00")
    q.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out" / "rows"))
    assert rows.count() == snaps.count()
    # raw snapshots fail the suite -> all routed to errors
    assert {r.route for r in rows.select("route").distinct().collect()} == {"errors"}
    reps = spark.read.json(str(tmp_path / "out" / "reports"))
    batch = RV.validation_reports(snaps.drop("county").withColumn("county", F.lit("x")), "t")
    assert reps.select("snapshot").distinct().count() == snaps.select("snapshot").distinct().count()
    assert batch.count() >= 1


def test_score_stream_matches_batch(spark, tmp_path):
    from homeledger.operators import model as M
    from homeledger.operators import score as SC
    from homeledger.plans.q_score import AS_OF, fitted, requests, scoring_schema
    from homeledger.schema import LISTING_KEYS
    from homeledger.streaming import score_stream
    schema = scoring_schema(spark, SF_SMALL)
    model = M.load_model(f"{fitted(spark, SF_SMALL)}/model")
    req = requests(spark, SF_SMALL)
    src = str(tmp_path / "req")
    req.write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    q = score_stream(stream, schema, model, AS_OF, LISTING_KEYS, str(tmp_path / "scored"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "scored"))
    want = SC.score_batch(spark.read.parquet(src), schema, model, AS_OF, LISTING_KEYS)
    cols = LISTING_KEYS + ["status_code", "predicted_price"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert got.count() == want.count()
