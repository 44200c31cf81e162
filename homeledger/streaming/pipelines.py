"""Streaming pipelines (see package docstring)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from homeledger.operators import review as RV
from homeledger.operators import score as SC


def validate_and_route_stream(stream: DataFrame, out_path: str, checkpoint: str, ts: str,
                              by: str = "snapshot") -> StreamingQuery:
    """Per micro-batch: reports for every snapshot in the batch (JSON) and the batch rows
    under ``batch_id=…/route=processed|errors/snapshot=…`` by verdict.

    A batch overwrites its own folders, so a replay repeats nothing.  The verdict
    is that of the batch: a snapshot must arrive in one batch (its files moved
    into the source folder at once) to be judged as a whole."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        reports = RV.validation_reports(batch, ts, by)
        reports.write.mode("overwrite").json(f"{out_path}/reports/batch_id={batch_id}")
        verdict = reports.select(by, F.when(F.col("success"), "processed").otherwise("errors").alias("route"))
        (batch.join(verdict, by)
              .write.mode("overwrite").partitionBy("route", by).parquet(f"{out_path}/rows/batch_id={batch_id}"))
        batch.unpersist()

    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def score_stream(stream: DataFrame, schema: SC.ScoringSchema, model, as_of: str, keys: list[str],
                 out_path: str, checkpoint: str) -> StreamingQuery:
    """Gate and score arriving requests; responses appended as Parquet."""
    scored = SC.score_batch(stream, schema, model, as_of, keys)
    return (scored.writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
