"""Fill-in-the-middle transformation by content-defined chunk memoization (operator 11).

A rolling hash over the last 32 bytes cuts the bytes of a text into chunks, so
equal passages give equal chunks wherever they stand.  A worker keeps a summary
of each chunk it has met: line ends, code points, whether a mark stands inside,
and the two bytes at either end, with which marks across boundaries are seen.
An entry is used only when its stored content equals the chunk.  Running sums of
the chunks' counts say which chunk holds the k-th line end; the summary says
where in it.  Nothing leaves the row's task: no shuffle, and memory is bounded
by the cache and one block of texts (a longer text is a block of its own).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import id_and_text, tidy, worker_state
from homeledger.llm.tokens import Generations

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (b"<P>", b"<S>", b"<M>")
#: A chunk ends where these bits of the rolling hash are 0: 512 bytes on average.
CUT_BITS = 9
#: Longer chunks are cut here, so that no entry of the cache grows with a text.
MOST_BYTES = 8192
#: Chunks that one generation of a worker's cache holds, and bytes of a block of texts.
CACHE_CHUNKS = 32_768
BLOCK_BYTES = 4 << 20

SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"


def chunk_ends(data):
    """Ends of the content-defined chunks of a byte array (the last one is its length)."""
    import numpy as np

    if not len(data):
        return np.zeros(0, np.int64)
    # gear hash: each byte's random number, doubled for every later byte, over 32 bytes
    mix = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mix ^= mix >> np.uint64(29)
    h = ((mix * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(32)).astype(np.uint32)[data]
    for k in range(5):
        step = 1 << k
        h[step:] += h[:-step] << np.uint32(step)
    ends = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    ends = np.append(ends[ends < len(data)], len(data))
    starts = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - starts > MOST_BYTES)
    if len(long):
        more = [np.arange(starts[i] + MOST_BYTES, ends[i], MOST_BYTES) for i in long]
        ends = np.sort(np.concatenate([ends, *more]))
    return ends


class Chunks(Generations):
    """Chunk hash -> (content, line ends, code points, mark inside, line-end offsets)."""

    def __init__(self):
        super().__init__(CACHE_CHUNKS)

    def make(self, key):  # filled by ``summary``, which has the content
        return None

    def summary(self, chunk: bytes):
        import xxhash

        key = xxhash.xxh64_intdigest(chunk)
        held = self[key]
        if held is None or held[0] != chunk:  # another content under this hash: its own summary
            lines, at = [], chunk.find(b"\n")
            while at >= 0:
                lines.append(at + 1)
                at = chunk.find(b"\n", at + 1)
            held = (chunk, len(lines), code_points(chunk), any(m in chunk for m in MARKS), lines)
            self[key] = held
        return held


def code_points(data: bytes) -> int:
    """UTF-8 code points that begin in ``data`` (bytes that are not continuations)."""
    import numpy as np

    return len(data) - int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 == 0x80))


class Summed:
    """The chunks of one text, with running sums of their counts."""

    def __init__(self, text: bytes, ends: list[int], cache: Chunks):
        self.text, self.ends = text, ends
        starts = [0, *ends[:-1]]
        self.parts = [cache.summary(text[a:b]) for a, b in zip(starts, ends)]
        self.starts = starts
        self.lines = list(accumulate(p[1] for p in self.parts))
        self.chars = [0, *accumulate(p[2] for p in self.parts)]
        self.n = (self.lines[-1] if ends else 0) + (not text.endswith(b"\n") if text else 0)

    def has_mark(self) -> bool:
        if any(p[3] for p in self.parts):
            return True
        edge = [self.text[max(0, b - 2):b + 2] for b in self.ends[:-1]]  # a mark has three bytes
        return any(m in e for e in edge for m in MARKS)

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) before the end of the ``k``-th unit."""
        if k == 0:
            return 0, 0
        if k > (self.lines[-1] if self.lines else 0):  # the last unit has no line end
            return len(self.text), self.chars[-1]
        i = bisect_left(self.lines, k)
        chunk, lines, _, _, at = self.parts[i]
        inside = at[k - 1 - (self.lines[i] - lines)]
        return self.starts[i] + inside, self.chars[i] + code_points(chunk[:inside])


def draws(doc_id, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document (a null id counts as the empty text)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * k:4 * k + 4], "big") for k in range(4))


def transform_text(doc_id, text: bytes, ends: list[int], cache: Chunks, seed: int, rate: int, spm: int):
    """(n, form, prefix_chars, middle_chars, output bytes) of one text."""
    t = Summed(text, ends, cache)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or t.has_mark():
        return t.n, "plain", None, None, text
    lo, hi = sorted((h1 % (t.n + 1), h2 % (t.n + 1)))
    (a, chars_a), (b, chars_b) = t.cut(lo), t.cut(hi)
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        form, out = "spm", b"<S>" + suf + b"<P>" + pre + b"<M>" + mid
    else:
        form, out = "psm", b"<P>" + pre + b"<S>" + suf + b"<M>" + mid
    return t.n, form, chars_a, chars_b - chars_a, out


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """Every document with its lines rearranged for infilling.

    ``rate`` is the share of documents transformed and ``spm`` that of them with
    the suffix first, both in per cent.  Returns ``doc_id``, ``n`` (lines),
    ``form`` (``plain``, ``psm`` or ``spm``), ``prefix_chars`` and
    ``middle_chars`` (code points, null where plain) and ``output``.

    A null text counts as empty and, like a text that holds a mark, stays plain.
    A null id draws like the empty text.  Repeated rows give repeated rows with
    the same result, an empty table an empty one; other columns are ignored,
    whatever their names.
    """
    rows = id_and_text(docs).select("doc_id", F.col("text").cast("binary").alias("text"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tidy("fim_chunks")
        cache = worker_state("fim_chunks", Chunks)
        for batch in batches:
            for ids, texts in blocks(batch):
                ends = chunk_ends(np.frombuffer(b"".join(texts), np.uint8))
                out, lo = [], 0
                for i, t in zip(ids, texts):
                    hi = lo + len(t)
                    own = ends[np.searchsorted(ends, lo, "right"):np.searchsorted(ends, hi, "left")] - lo
                    out.append(transform_text(i, t, [*own.tolist(), len(t)] if t else [], cache, seed, rate, spm))
                    lo = hi
                n, form, pre, mid, text = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.column(0).type), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(pre, pa.int64()), pa.array(mid, pa.int64()),
                     pa.array(text, pa.binary()).cast(pa.string(), safe=False)],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
        tidy("fim_chunks")

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")


def blocks(batch):
    """(ids, texts) of an Arrow batch in runs of about ``BLOCK_BYTES``, one row at least."""
    ids, texts, size = [], [], 0
    for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
        t = t.as_py()
        if ids and size + len(t) > BLOCK_BYTES:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(t)
        size += len(t)
    if ids:
        yield ids, texts


def restore(output: Column, form: Column) -> Column:
    """The text that ``transform`` was given, from its output and form alone."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def digests(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """``transform`` with the SHA-256 of the output and of the text restored from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return transform(docs, seed, rate, spm).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))


def duck_sql(seed: int = 7, rate: int = 100, spm: int = 50) -> str:
    """DuckDB twin of ``digests`` over the view ``documents``."""
    h = lambda k: f"('0x' || substr(sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')), {8 * k + 1}, 8))::BIGINT"
    return f"""
WITH l AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
                  {h(0)} AS h1, {h(1)} AS h2, {h(2)} AS h3, {h(3)} AS h4 FROM documents),
n AS (SELECT *, len(units) AS n, text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
             OR h3 % 100 >= {rate} AS plain FROM l),
k AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi FROM n),
p AS (SELECT *, array_to_string(units[1:lo], '') AS pre, array_to_string(units[lo + 1:hi], '') AS mid,
             array_to_string(units[hi + 1:n], '') AS suf FROM k),
o AS (SELECT *, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < {spm} THEN 'spm' ELSE 'psm' END AS form FROM p)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN NOT plain THEN length(pre) END::BIGINT AS prefix_chars,
       CASE WHEN NOT plain THEN length(mid) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE WHEN plain THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM o"""
