"""Incremental runs of the batch operators with Structured Streaming.

* :func:`validate_and_route_stream` — snapshots arriving as files are
  validated per micro-batch (one grouped suite aggregate) and their rows are
  routed to ``route=processed|errors`` partitions; reports are appended.
* :func:`score_stream` — requests arriving as files are gated and scored by
  the same column expressions as :func:`homeledger.operators.score.score_batch`
  (stateless, so no watermark or state store is needed).

Checkpoints live under ``spark.checkpoint.dir`` so a restarted query resumes
exactly where it stopped.
"""

from homeledger.streaming.pipelines import score_stream, validate_and_route_stream  # noqa: F401
