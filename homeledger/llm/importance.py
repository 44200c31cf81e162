"""Quality by importance resampling (operator 4).

Words and pairs of neighbouring words are hashed into ``BUCKETS`` buckets.  Two
bag-of-n-grams models are counted: raw text (every document) and target text
(documents labelled good).  A document's log weight is the sum over its n-grams
of log target share minus log raw share; with Gumbel noise drawn from a hash of
its id, the ``keep_share`` documents with the highest sums are a weighted sample
without replacement (Gumbel top-k).

The raw model counts all rows.  The target model, a fitted classifier, reads at
most ``max_target`` labelled documents (expected).  The models are two arrays
of ``BUCKETS`` counts, which bounds the shuffle rows, the driver and the
broadcast; the cut between kept and left documents is an exact order statistic
counted over all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeledger.functions.quantiles import exact_quantiles
from homeledger.llm.shared import id_and_text, ship
from homeledger.llm.wordhash import batches_of, pair_hashes, word_hashes
from homeledger.session import materialize

BUCKETS = 1 << 16
MAX_TARGET = 20_000
KEEP_SHARE = 0.85
SEED = 11


def grams(texts: list[bytes], buckets: int = BUCKETS):
    """(text number, bucket) of every word and word pair of lower-cased texts."""
    import numpy as np

    owner, h = word_hashes(texts)
    owner2, h2 = pair_hashes(owner, h)
    return np.concatenate([owner, owner2]), (np.concatenate([h, h2]) % np.uint64(buckets)).astype(np.int64)


def bucket_counts(flagged: DataFrame, buckets: int):
    """Counts (raw, target) per bucket of ``flagged`` (doc_id, text, target)."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        count = np.zeros((2, buckets), np.int64)
        for b in batches:
            target = np.asarray(b.column(2).to_pylist(), bool)
            for lo, texts in batches_of(b.column(1).to_pylist()):
                owner, bucket = grams(texts, buckets)
                count[0] += np.bincount(bucket, minlength=buckets)
                good = target[lo + owner]
                if good.any():
                    count[1] += np.bincount(bucket[good], minlength=buckets)
        at = np.flatnonzero(count[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[0][at]), pa.array(count[1][at])],
                                         names=["bucket", "raw", "target"])

    got = (flagged.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket")
           .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas())
    out = np.zeros((2, buckets))
    out[0][got["bucket"]], out[1][got["bucket"]] = got["raw"], got["target"]
    return out


class LogRatios:
    """Log target share minus log raw share of every bucket (one count added to each)."""

    def __init__(self, raw, target):
        import numpy as np

        share = lambda c: np.log((c + 1) / (c.sum() + len(c)))
        self.ratio = share(target) - share(raw)


def resample(docs: DataFrame, labels: DataFrame, keep_share: float = KEEP_SHARE, max_target: int = MAX_TARGET,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, gumbel_key, selected) of every document.

    ``selected``: the round(keep_share * rows) rows with the highest
    ``gumbel_key``; rows that tie with the last of them are selected too.  A
    null text or one without words has no n-grams and weight 0.  Rows with the
    same id (or none) draw the same noise; repeated rows are rows of their own;
    without a good label the target is uniform; an empty table gives an empty
    result; other columns are ignored, whatever their names; very long texts
    are read whole.
    """
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    n = good.count()
    draw = F.expr("(xxhash64(doc_id) & 2147483647L) / 2147483648D") < (min(1.0, max_target / n) if n else 0.0)
    # max_target ids are expected, which bounds the broadcast
    drawn = F.broadcast(good.where(draw).withColumn("target", F.lit(True)))
    rows = id_and_text(docs)
    flagged = rows.join(drawn, "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    raw, target = bucket_counts(flagged, buckets)
    load = ship(docs.sparkSession, LogRatios(raw, target))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ratio = load().ratio
        for b in batches:
            size, weight = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for lo, texts in batches_of(b.column(1).to_pylist()):
                owner, bucket = grams(texts, buckets)
                part = slice(lo, lo + len(texts))
                size[part] = np.bincount(owner, minlength=len(texts))
                weight[part] = np.bincount(owner, ratio[bucket], len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size), pa.array(weight)],
                                             names=["doc_id", "n_grams", "log_weight"])

    noise = F.expr(f"-ln(-ln(((xxhash64(doc_id, {seed}) & 9007199254740991L) + 0.5D) / 9007199254740992D))")
    scored = materialize(rows.mapInArrow(run, f"doc_id {kind}, n_grams long, log_weight double")
                         .withColumn("gumbel_key", F.col("log_weight") + noise), "importance")
    total = scored.count()
    k = round(keep_share * total)
    if k <= 0 or k >= total:
        return scored.withColumn("selected", F.lit(k > 0))
    # half way between the last row kept and the first one left
    cut = exact_quantiles(scored, ["gumbel_key"], [(total - k - 0.5) / (total - 1)])
    return (scored.crossJoin(F.broadcast(cut.select(F.col("__q_gumbel_key")[0].alias("cut"))))
            .withColumn("selected", F.col("gumbel_key") >= F.col("cut")).drop("cut"))
