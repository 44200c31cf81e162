"""Substring deduplication by fixed-block anchors (operator 12).

A word sequence of ``window`` words that two documents share holds, whole, one
of the non-overlapping blocks of ``(window + 1) // 2`` words into which either
of them is cut.  So only the blocks are indexed, and every rolling window of
block length probes the index:

1. Documents lie in a written table in chunks of some megabytes.  A chunk sends
   each bucket of hashes one message: its distinct rolling hashes, packed to
   about two bytes each, and its block hashes with the smallest document id.
2. A bucket answers which of them meet a block of another place, and the
   smallest id that has it.  These are the hits: blocks that something else met,
   and rolling windows that a block of a smaller document meets.
3. A hit is extended to the left and right: all windows of ``window`` words that
   hold it are compared with those that hold the blocks it met, again by one
   message per chunk and bucket, with whole 64-bit hashes.  A document loses
   the extensions that agree with one of a smaller document; where they overlap
   they join into maximal repeats.

No pair of documents is formed and no row is made per hit: a chunk names a hash
once, however many documents share a passage, so no key is hot and no group
grows beyond a bucket's share.  Messages number at most chunks times buckets,
and never more than the hashes in them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import id_and_text, tidy
from homeledger.llm.wordhash import word_hashes
from homeledger.session import materialize, scratch_path

#: Bytes of text and rows of a chunk; words of a bucket; parts into which the join of copies deals one key.
CHUNK_BYTES = 4 << 20
CHUNK_ROWS = 1 << 16
BUCKET_WORDS = 4_000_000
SALTS = 16
_RUN = 1 << 20
_NONE = (1 << 63) - 1


# ---- hashes -------------------------------------------------------------

def hash_words(texts: list[bytes]):
    """(first word of each text and the end, hash of each word); words are joined by one space."""
    import numpy as np

    counts = [t.count(b" ") + 1 if t else 0 for t in texts]
    out, run, size = [], [], 0
    for t in texts:
        lo = 0
        while lo < len(t):
            hi = t.find(b" ", lo + _RUN)  # very long texts in pieces: memory stays bounded
            hi = len(t) if hi < 0 else hi
            run.append(t[lo:hi])
            size += hi - lo
            lo = hi + 1
            if size >= _RUN:
                out.append(word_hashes(run)[1])
                run, size = [], 0
    out.append(word_hashes(run)[1] if run else np.zeros(0, np.uint64))
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), np.concatenate(out)


def rolling(h, size: int):
    """Hash of every ``size`` neighbouring words: halves of a power of two are joined level by level."""
    import numpy as np

    def join(a, b, level):
        x = a * np.uint64(0xD6E8FEB86659FD93 + 2 * level) + b
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return x

    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, part, s = None, 0, h, 1
    while True:
        if size & s:
            own = part[done:done + n]
            out = own.copy() if out is None else join(out[:n], own, s)
            done += s
        if done == size:
            return out
        part = join(part[:len(part) - s], part[s:], s)
        s *= 2


class Rolled:
    """Rolling block hashes of a chunk's texts, with owner and place."""

    def __init__(self, texts: list[bytes], block: int):
        import numpy as np

        self.first, self.h = hash_words(texts)
        x = rolling(self.h, block)
        lengths = np.diff(self.first)
        owner = np.repeat(np.arange(len(texts)), lengths)
        own = owner[:len(x)] == owner[block - 1:] if len(x) else np.zeros(0, bool)
        self.at = np.flatnonzero(own)
        self.x, self.owner = x[self.at], owner[self.at]
        self.place = self.at - self.first[self.owner]
        self.aligned = self.place % block == 0

    def keys(self, buckets: int):
        """Bucket in the upper and 32 bits of the hash in the lower half."""
        import numpy as np

        return ((self.x >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (self.x & np.uint64(0xFFFFFFFF))


def pack(v) -> bytes:
    """Sorted distinct 32-bit numbers: low bytes as they are, the high part as one bit string."""
    import numpy as np

    low = 2 if len(v) >= 8192 else 3
    high = (v >> np.uint32(8 * low)).astype(np.int64) + np.arange(len(v))
    bits = np.zeros(len(v) + (1 << (32 - 8 * low)), np.uint8)
    bits[high] = 1
    return v.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :low].tobytes() + np.packbits(bits).tobytes()


def unpack(data: bytes, n: int):
    import numpy as np

    low = 2 if n >= 8192 else 3
    raw = np.frombuffer(data, np.uint8)
    high = np.flatnonzero(np.unpackbits(raw[low * n:])) - np.arange(n)
    out = np.zeros((n, 4), np.uint8)
    out[:, :low] = raw[:low * n].reshape(n, low)
    return out.view("<u4")[:, 0] | (high.astype(np.uint32) << np.uint32(8 * low))


# ---- stages -------------------------------------------------------------

def chunked(docs: DataFrame) -> DataFrame:
    """Written table (chunk, rid, doc_id, id, n_words, text) with words joined by one space."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = id_and_text(docs).select("doc_id", F.col("doc_id").cast("long").alias("id"),
                                    F.col("text").cast("binary").alias("text"))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        tidy()
        part, seq = TaskContext.get().partitionId() << 24, 0

        def chunk(ids, longs, texts):
            c = part | seq
            return pa.RecordBatch.from_arrays(
                [pa.array([c] * len(ids), pa.int64()), pa.array([c << 16 | k for k in range(len(ids))], pa.int64()),
                 pa.array(ids, kind_of), pa.array(longs, pa.int64()),
                 pa.array([t.count(b" ") + 1 if t else 0 for t in texts], pa.int64()),
                 pa.array(texts, pa.binary()).cast(pa.string(), safe=False)],
                names=["chunk", "rid", "doc_id", "id", "n_words", "text"])

        held, size, kind_of = ([], [], []), 0, None
        for b in batches:
            kind_of = b.column(0).type
            for i, j, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                t = b" ".join(t.as_py().split())  # \x20 and \x09-\x0D only
                if held[0] and (size + len(t) > CHUNK_BYTES or len(held[0]) == CHUNK_ROWS):
                    yield chunk(*held)
                    held, size, seq = ([], [], []), 0, seq + 1
                for col, v in zip(held, (i, j, t)):
                    col.append(v)
                size += len(t)
        if held[0]:
            yield chunk(*held)
        tidy()

    out = rows.mapInArrow(run, f"chunk long, rid long, doc_id {kind}, id long, n_words long, text string")
    path = scratch_path(docs.sparkSession, "anchors-chunks")
    out.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def messages(docs: DataFrame, block: int, buckets: int) -> DataFrame:
    """One row per chunk and bucket: packed distinct rolling hashes, block hashes and their smallest ids."""

    def send(chunk, ids, texts):
        import numpy as np
        import pyarrow as pa

        r = Rolled(texts, block)
        keys, inv, seen = np.unique(r.keys(buckets), return_inverse=True, return_counts=True)
        low = np.full(len(keys), _NONE)
        np.minimum.at(low, inv[r.aligned], np.array(ids, np.int64)[r.owner[r.aligned]])
        has = np.zeros(len(keys), bool)
        has[inv[r.aligned]] = True
        asks = ~(has & (seen == 1))  # a block that stands here once need not ask for itself
        probes, refs, low = keys[asks], keys[has], low[has]
        b = np.unique(keys >> np.uint64(32))
        cut = lambda k: np.searchsorted(k, np.concatenate([b, b[-1:] + np.uint64(1)]) << np.uint64(32))
        p, q = cut(probes), cut(refs)
        probes, refs = probes.astype(np.uint32), refs.astype("<u4")
        span = range(len(b))
        return pa.RecordBatch.from_arrays(
            [pa.array(b.astype(np.int64)), pa.array([chunk] * len(b), pa.int64()),
             pa.array([p[i + 1] - p[i] for i in span], pa.int64()),
             pa.array([pack(probes[p[i]:p[i + 1]]) for i in span], pa.binary()),
             pa.array([refs[q[i]:q[i + 1]].tobytes() for i in span], pa.binary()),
             pa.array([low[q[i]:q[i + 1]].astype("<i8").tobytes() for i in span], pa.binary())],
            names=["bucket", "chunk", "n", "probes", "refs", "low"])

    def run(batches):
        tidy()
        at, ids, texts = None, [], []
        for b in batches:
            for c, i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if c != at and ids:  # a chunk cut by a file split sends two messages
                    yield send(at, ids, texts)
                    ids, texts = [], []
                at = c
                ids.append(i)
                texts.append(t.as_py())
        if ids:
            yield send(at, ids, texts)
        tidy()

    return (docs.select("chunk", "id", "text")
            .mapInArrow(run, "bucket long, chunk long, n long, probes binary, refs binary, low binary"))


def answers(sent: DataFrame) -> DataFrame:
    """One row per message with hits: (chunk, bucket, hashes, smallest id that has each as a block)."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        refs = [np.frombuffer(v, "<u4") for v in table.column("refs").to_pylist()]
        low = np.concatenate([np.frombuffer(v, "<i8") for v in table.column("low").to_pylist()])
        known, inv, n = np.unique(np.concatenate(refs), return_inverse=True, return_counts=True)
        least = np.full(len(known), _NONE)
        np.minimum.at(least, inv, low)
        met, asked = n > 1, []
        for data, k in zip(table.column("probes"), table.column("n").to_pylist()):
            v = unpack(data.as_py(), k)
            at = np.minimum(np.searchsorted(known, v), max(len(known) - 1, 0))
            hit = at[known[at] == v] if len(known) else at[:0]
            met[hit] = True
            asked.append(hit.astype(np.uint32))
        out, lo = [], 0
        for c, hit, own in zip(table.column("chunk").to_pylist(), asked, refs):
            mine = inv[lo:lo + len(own)]
            lo += len(own)
            every = np.union1d(hit, mine[met[mine]])
            if len(every):
                out.append((c, known[every].astype("<u4").tobytes(), least[every].astype("<i8").tobytes()))
        b = table.column("bucket")[0].as_py()
        return pa.table([pa.array([c for c, _, _ in out], pa.int64()), pa.array([b] * len(out), pa.int64()),
                         pa.array([x for _, x, _ in out], pa.binary()), pa.array([m for _, _, m in out], pa.binary())],
                        names=["chunk", "bucket", "x", "low"])

    return sent.groupBy("bucket").applyInArrow(run, "chunk long, bucket long, x binary, low binary")


def copies(docs: DataFrame) -> DataFrame:
    """(chunk, rid) of every document whose words another one with a smaller id has, all of them."""
    ids = docs.select("chunk", "rid", "id", F.unhex(F.sha2("text", 256)).alias("sha"))
    first = ids.groupBy("sha").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    first = first.where("first_id < last_id").select(
        "sha", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return (ids.withColumn("salt", F.pmod("rid", F.lit(SALTS)).cast("int")).join(first, ["sha", "salt"])
            .where("id > first_id").select("chunk", "rid"))


def _replies(table, kind: str):
    """(sorted hashes, smallest id of each) of a chunk's replies."""
    import numpy as np

    rows = [(b, x, m) for b, x, m in zip(*(table.column(c).to_pylist() for c in ("bucket", "x", "low"))) if x is not None]
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key = np.concatenate([np.frombuffer(x, kind).astype(np.uint64) | np.uint64((b << 32) if kind == "<u4" else 0)
                          for b, x, _ in rows])
    low = np.concatenate([np.frombuffer(m, "<i8") for _, _, m in rows])
    key, one = np.unique(key, return_index=True)  # the parts of a cut chunk may both have asked
    return key, low[one]


def _look_up(key, low, mine):
    """Smallest id known for each of ``mine``, or a number above all ids."""
    import numpy as np

    if not len(key):
        return np.full(len(mine), _NONE)
    at = np.minimum(np.searchsorted(key, mine), len(key) - 1)
    return np.where(key[at] == mine, low[at], _NONE)


def _stretch(places, size: int, before: int, first, last):
    """Marks of the window starts up to ``before`` words before each place, between ``first`` and ``last``."""
    import numpy as np

    lo, hi = np.maximum(places - before, first), np.minimum(places, last)
    lo, hi = lo[hi >= lo], hi[hi >= lo]
    step = np.bincount(lo, minlength=size + 1) - np.bincount(hi + 1, minlength=size + 1)
    return np.cumsum(step[:size]) > 0


def extensions(docs: DataFrame, replies: DataFrame, window: int, buckets: int) -> DataFrame:
    """One row per chunk and bucket: hashes of the windows that hold a hit, which of them ask, and the
    smallest id of those that hold a block which was met."""
    block = (window + 1) // 2
    names = ["bucket", "chunk", "n", "w", "ask", "ref", "low"]

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        empty = pa.table([pa.array([], t) for t in (pa.int64(),) * 3 + (pa.binary(),) * 4], names=names)
        key, low = _replies(right, "<u4")
        gone = {r for r in right.column("rid").to_pylist() if r is not None}
        left = left.filter(pa.array([r not in gone for r in left.column("rid").to_pylist()], pa.bool_()))
        if not left.num_rows or not len(key):
            return empty
        ids = left.column("id").to_numpy()
        r = Rolled(left.column("text").to_pylist(), block)
        met = _look_up(key, low, r.keys(buckets))
        first, last = r.first[:-1][r.owner], r.first[1:][r.owner] - window
        marks = []
        for take in (met < ids[r.owner], (met < _NONE) & r.aligned):
            marks.append(_stretch(r.at[take], len(r.h), window - block, first[take], last[take]))
        ask, ref = marks
        place = np.flatnonzero(ask | ref)
        if not len(place):
            return empty
        w, inv = np.unique(rolling(r.h, window)[place], return_inverse=True)
        least = np.full(len(w), _NONE)
        owner = np.searchsorted(r.first, place, side="right") - 1
        own = ref[place]
        np.minimum.at(least, inv[own], ids[owner[own]])
        asks = np.zeros(len(w), bool)
        asks[inv[ask[place]]] = True
        to = (w >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(to, kind="stable")
        w, least, asks, to = w[order], least[order], asks[order], to[order]
        b, at = np.unique(to, return_index=True)
        parts = list(zip(at, [*at[1:], len(to)]))
        known = least < _NONE
        return pa.table(
            [pa.array(b.astype(np.int64)), pa.array([left.column("chunk")[0].as_py()] * len(b), pa.int64()),
             pa.array([j - i for i, j in parts], pa.int64()),
             pa.array([w[i:j].astype("<u8").tobytes() for i, j in parts], pa.binary()),
             pa.array([np.packbits(asks[i:j]).tobytes() for i, j in parts], pa.binary()),
             pa.array([np.packbits(known[i:j]).tobytes() for i, j in parts], pa.binary()),
             pa.array([least[i:j][known[i:j]].astype("<i8").tobytes() for i, j in parts], pa.binary())], names=names)

    return (docs.groupBy("chunk").cogroup(replies.groupBy("chunk"))
            .applyInArrow(run, "bucket long, chunk long, n long, w binary, ask binary, ref binary, low binary"))


def agreed(sent: DataFrame) -> DataFrame:
    """(chunk, bucket, hashes, smallest id) of the windows that a chunk asked for and some document has."""

    def run(table):
        import numpy as np
        import pyarrow as pa

        bits = lambda data, n: np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)
        rows = [(c, np.frombuffer(w, "<u8"), bits(a, n), bits(k, n), np.frombuffer(m, "<i8")) for c, n, w, a, k, m in
                zip(*(table.column(c).to_pylist() for c in ("chunk", "n", "w", "ask", "ref", "low")))]
        known, inv = np.unique(np.concatenate([w[k] for _, w, _, k, _ in rows]), return_inverse=True)
        least = np.full(len(known), _NONE)
        np.minimum.at(least, inv, np.concatenate([m for *_, m in rows]))
        out = []
        for c, w, asks, _, _ in rows:
            mine = w[asks]
            low = _look_up(known, least, mine)
            some = low < _NONE
            if some.any():
                out.append((c, mine[some].tobytes(), low[some].astype("<i8").tobytes()))
        return pa.table([pa.array([c for c, _, _ in out], pa.int64()),
                         pa.array([table.column("bucket")[0].as_py()] * len(out), pa.int64()),
                         pa.array([x for _, x, _ in out], pa.binary()), pa.array([m for _, _, m in out], pa.binary())],
                        names=["chunk", "bucket", "x", "low"])

    return sent.groupBy("bucket").applyInArrow(run, "chunk long, bucket long, x binary, low binary")


def _kept(doc_id, n_words, texts, gone):
    """Result columns from the marks of removed words, one array per text (None: nothing is removed)."""
    import numpy as np
    import pyarrow as pa

    n_removed, spans, kept = [], [], []
    for t, g in zip(texts, gone):
        if g is None or not g.any():
            n_removed.append(0)
            spans.append([])
            kept.append(t)
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]]))).reshape(-1, 2)
        n_removed.append(int(g.sum()))
        spans.append([{"start": int(s), "length": int(e - s)} for s, e in edge])
        kept.append(b" ".join([w for w, x in zip(t.split(b" "), g.tolist()) if not x]))
    return pa.table([doc_id, n_words, pa.array(n_removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
                     pa.array(kept, pa.binary()).cast(pa.string(), safe=False)],
                    names=["doc_id", "n_words", "n_removed", "spans", "kept"])


def removed(docs: DataFrame, replies: DataFrame, window: int, schema: str) -> DataFrame:
    """The documents without the windows that a smaller document has."""

    def run(left, right):
        import numpy as np

        ids, texts = left.column("id").to_numpy(), left.column("text").to_pylist()
        whole = {r for r in right.column("rid").to_pylist() if r is not None}
        key, low = _replies(right, "<u8")
        gone = [None] * len(texts)
        if len(key):
            first, h = hash_words(texts)
            met = _look_up(key, low, rolling(h, window))
            owner = np.repeat(np.arange(len(texts)), np.diff(first))
            start = np.flatnonzero((met < ids[owner[:len(met)]]) & (owner[:len(met)] == owner[window - 1:]))
            step = np.zeros(len(h) + 1, np.int64)
            np.add.at(step, start, 1)
            np.add.at(step, start + window, -1)
            marks = np.cumsum(step[:-1]) > 0
            gone = [marks[a:b] for a, b in zip(first, first[1:])]
        for k, (r, n) in enumerate(zip(left.column("rid").to_pylist(), left.column("n_words").to_pylist())):
            if r in whole:
                gone[k] = np.ones(n, bool)
        return _kept(left.column("doc_id"), left.column("n_words"), texts, gone)

    return docs.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """Every document without the words that repeat ``window`` or more words of one with a smaller ``doc_id``.

    Returns ``doc_id``, ``n_words``, ``n_removed``, ``spans`` (start and length,
    in words, of each maximal run removed) and ``kept`` (the other words, joined
    by one space).  Repeats are judged on the input.

    A null text has no words.  Documents with a null id, or one that is no whole
    number, neither remove nor lose words; equal ids do not remove each other's
    words; repeated rows give repeated rows.  An empty table gives an empty
    result; other columns are ignored, whatever their names.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    block, table = (window + 1) // 2, chunked(docs)
    schema = (f"doc_id {table.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, "
              "spans array<struct<start: long, length: long>>, kept string")
    long = (F.col("n_words") >= window) & F.col("id").isNotNull()
    rows = table.where(long).withColumn("text", F.col("text").cast("binary"))
    size = rows.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_WORDS))
    gone = materialize(copies(rows), "anchors-copies")
    add = lambda told: told.unionByName(gone, allowMissingColumns=True)
    hits = add(answers(messages(rows, block, buckets)))
    more = add(agreed(extensions(rows, hits, window, buckets)))
    rest = table.where(~long).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"),
                                     F.expr("cast(array() AS array<struct<start: long, length: long>>)").alias("spans"),
                                     F.col("text").alias("kept"))
    return removed(rows, more, window, schema).unionByName(rest)


def digests(docs: DataFrame, window: int = 50) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of the kept words."""
    return remove_repeats(docs, window).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def duck_sql(window: int = 50) -> str:
    """DuckDB twin of ``digests`` over the view ``documents``: every window as a list of words."""
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id,
       regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
x AS MATERIALIZED (SELECT rid, doc_id, len(ws) AS n, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT rid, doc_id, i, array_to_string(list(word) OVER (PARTITION BY rid ORDER BY i
             ROWS BETWEEN CURRENT ROW AND {window - 1} FOLLOWING), ' ') AS gram, n FROM x),
f AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS low
                          FROM g WHERE i + {window - 1} <= n) WHERE low < doc_id),
c AS (SELECT x.rid, x.i, x.word, max(f.i) OVER (PARTITION BY x.rid ORDER BY x.i
             ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
      FROM x LEFT JOIN f ON x.rid = f.rid AND x.i = f.i),
s AS (SELECT rid, count(*) FILTER (gone) AS n_removed,
             coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '') AS kept FROM c GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (rid)"""
