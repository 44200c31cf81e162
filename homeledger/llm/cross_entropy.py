"""Cross-entropy difference of two matched word-bigram models (operator 8).

The background model counts every document, the target model the documents
labelled good; both use all words of the corpus (and one open class for any
other), the same order and the same smoothing: bigram counts less ``DISCOUNT``,
interpolated with add-one unigrams.  A document's score is the mean over its
words of the target loss less the background loss, in bits; lower means closer
to the target.

No table of words or counts reaches the driver or is broadcast.  Documents are
coded in blocks of about ``BLOCK_CHARS``; a block counts its distinct pairs and
words and asks for their totals over the corpus, one compressed message to each
bucket that it has keys in.  Buckets grow in number with the input and add up
what the blocks have sent.  A pair's bucket depends on both words, so that the
pairs of a frequent word spread over an eighth of the buckets; each bucket tells
its followers of every word to the bucket of that word.  The totals return to
the blocks, which score their documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import id_and_text, ship, tidy
from homeledger.session import materialize

VOCABULARY = 2048
DISCOUNT = 0.75
BLOCK_CHARS = 6_000_000
BUCKET_BYTES = 4 << 20
UNKNOWN = b"\t"  # no word holds white space
WORDS = "filter(split(lower(text), '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')"


def frequent_words(docs: DataFrame, most: int) -> list[bytes]:
    """The ``most`` most frequent words of all documents, ties in byte order."""
    words = id_and_text(docs).select(F.explode(F.expr(WORDS)).alias("w"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(most).collect()
    return [r["w"].encode() for r in top]


class Vocabulary:
    """The words that are told apart, where the caller limits them."""

    def __init__(self, words: list[bytes]):
        self.words = frozenset(words)


def squeeze(*arrays) -> bytes:
    """Arrays of one length and type as compressed bytes."""
    import zlib

    return zlib.compress(b"".join(a.tobytes() for a in arrays), 1)


def expand(data: bytes, kind: str, n: int = 1):
    """The ``n`` arrays of :func:`squeeze`, as rows."""
    import zlib

    import numpy as np

    return np.frombuffer(zlib.decompress(data), kind).reshape(n, -1)


def blocks(docs: DataFrame, labels: DataFrame, vocabulary: list[bytes] | None) -> DataFrame:
    """One row per block of documents: ids, number of words, target flag, word numbers and the block's words.

    Word number 0 stands before the first word.  The labels grow with the
    corpus, so the join is a merge at every size; rows without an id are dealt
    by their text.
    """
    rows = id_and_text(docs).withColumn("text", F.lower("text")).withColumn(
        "salt", F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)))
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(
        "doc_id", F.lit(0).cast("long").alias("salt")).distinct().withColumn("target", F.lit(True))
    flagged = rows.join(good.hint("merge"), ["doc_id", "salt"], "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    load = ship(docs.sparkSession, Vocabulary(vocabulary)) if vocabulary is not None else None

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        known = load().words if load else None
        part, made = TaskContext.get().partitionId() << 32, 0
        word_ids: dict = {b"": 0}
        ids, n, flags, coded, chars = [], [], [], [], 0

        def flush():
            return pa.RecordBatch.from_arrays([
                pa.array([part + made], pa.int64()), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)),
                pa.array([squeeze(np.array(n, "<i4"))], pa.binary()), pa.array([squeeze(np.array(flags, "u1"))], pa.binary()),
                pa.array([squeeze(*coded)], pa.binary()), pa.array([zlib.compress(b"\n".join(word_ids), 1)], pa.binary())],
                names=["block", "ids", "n", "target", "coded", "words"])

        for b in batches:
            for i, (text, target) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                words = text.encode().split()
                if known is not None:
                    words = [w if w in known else UNKNOWN for w in words]
                coded.append(np.array([word_ids.setdefault(w, len(word_ids)) for w in words], "<i4"))
                ids.append(b.column(0).slice(i, 1))
                n.append(len(words))
                flags.append(target)
                chars += len(text) + 100
                if chars >= BLOCK_CHARS:
                    yield flush()
                    made += 1
                    word_ids = {b"": 0}
                    ids, n, flags, coded, chars = [], [], [], [], 0
        if ids:
            yield flush()
        tidy()

    return materialize(flagged.mapInArrow(
        run, f"block long, ids array<{kind}>, n binary, target binary, coded binary, words binary"), "word-blocks")


class Block:
    """A block's words and distinct pairs (numbers before and after), counted over all and over target documents."""

    def __init__(self, n: bytes, target: bytes, coded: bytes, words: bytes):
        import zlib

        import numpy as np

        self.words = zlib.decompress(words).split(b"\n")
        self.n, self.target = expand(n, "<i4")[0], expand(target, "u1")[0]
        self.word = expand(coded, "<i4")[0]
        before = np.concatenate([np.zeros(1, "<i4"), self.word])[:-1]
        self.first = np.cumsum(self.n) - self.n
        before[self.first[self.n > 0]] = 0
        self.flag = np.repeat(self.target, self.n).astype(float)
        pair, self.at = np.unique(before.astype(np.int64) << 32 | self.word, return_inverse=True)
        self.u, self.w = pair >> 32, pair & 0xFFFFFFFF
        self.all = np.bincount(self.at, minlength=len(pair)).astype(np.int64)
        self.good = np.bincount(self.at, self.flag, len(pair)).astype(np.int64)
        self.hash = hashes(self.words)

    def by_bucket(self, buckets: int):
        """(bucket, pair numbers) of every bucket that has pairs of this block."""
        import numpy as np

        wide = spread(buckets)
        bucket = (self.hash[self.u] + self.hash[self.w] // 7 % wide * max(1, buckets // wide)) % buckets
        return cut(bucket, np.arange(len(bucket)))

    def word_counts(self):
        """Per word: times as a word (all, target) and as the word before (all, target)."""
        import numpy as np

        size = len(self.words)
        return [np.bincount(k, c, size).astype("<i8") for k in (self.w, self.u) for c in (self.all, self.good)]


def spread(buckets: int) -> int:
    """How many buckets the pairs of one first word may take."""
    return min(buckets, max(16, buckets // 8))


def hashes(words: list[bytes]):
    import zlib

    import numpy as np

    return np.fromiter(map(zlib.crc32, words), np.int64, len(words))


def cut(bucket, what):
    """(bucket, its ``what`` in order) of every bucket that occurs."""
    import numpy as np

    order = np.argsort(bucket, kind="stable")
    own = bucket[order]
    ends = np.flatnonzero(np.diff(own, append=-1)) + 1
    lo = 0
    for hi in ends.tolist():
        yield int(own[lo]), what[order[lo:hi]]
        lo = hi


MESSAGE = "bucket long, block long, body binary, counts binary"
REPLY = "block long, bucket long, pairs boolean, body binary, kinds long, words binary"


def _batches(rows, names, types, most: int = 8 << 20):
    """Record batches of rows (tuples), about ``most`` bytes each."""
    import pyarrow as pa

    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 64 + sum(len(x) for x in r if isinstance(x, bytes))
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def messages(coded: DataFrame, buckets: int, pairs: bool) -> DataFrame:
    """What the blocks ask for: their pairs (words joined by a space) or their words, with own counts."""

    def rows(b):
        import zlib

        import numpy as np

        for block, *own in zip(*(b.column(k).to_pylist() for k in range(b.num_columns))):
            held = Block(*own)
            words = held.words
            if pairs:
                for bucket, at in held.by_bucket(buckets):
                    keys = [words[u] + b" " + words[w] for u, w in zip(held.u[at].tolist(), held.w[at].tolist())]
                    yield bucket, block, zlib.compress(b"\n".join(keys), 1), squeeze(held.all[at], held.good[at])
            else:
                counts = held.word_counts()
                for bucket, at in cut(held.hash % buckets, np.arange(len(words))):
                    yield (bucket, block, zlib.compress(b"\n".join([words[k] for k in at.tolist()]), 1),
                           squeeze(*(c[at] for c in counts)))

    def run(batches):
        import pyarrow as pa

        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for b in batches:
            yield from _batches(rows(b), ["bucket", "block", "body", "counts"], types)

    return coded.select("block", "n", "target", "coded", "words").mapInArrow(run, MESSAGE)


def _answers(table, n: int):
    """Number the keys of one bucket's messages: (numbers of each message, own counts of each, totals, keys)."""
    import zlib

    import numpy as np

    number: dict = {}
    at, own = [], []
    for body, counts in zip(table.column("body").to_pylist(), table.column("counts").to_pylist()):
        keys = zlib.decompress(body).split(b"\n")
        at.append(np.array([number.setdefault(k, len(number)) for k in keys]))
        own.append(expand(counts, "<i8", n))
    every = np.concatenate(at)
    total = [np.bincount(every, np.concatenate([c[k] for c in own]), len(number)).astype("<i8") for k in range(n)]
    return at, own, total, list(number)


def pair_totals(coded: DataFrame, buckets: int) -> DataFrame:
    """Replies with the pairs' totals where other blocks have them too, and each bucket's followers by word."""

    def run(table):
        import zlib

        import numpy as np
        import pyarrow as pa

        at, own, (c, t), keys = _answers(table, 2)
        bucket, out = table.column("bucket")[0].as_py(), []
        for block, k, (a, g) in zip(table.column("block").to_pylist(), at, own):
            more = np.flatnonzero((c[k] != a) | (t[k] != g))
            if len(more):
                out.append((block, bucket, True, squeeze(more, c[k][more], t[k][more]), 0, None))
        number: dict = {}
        first = np.array([number.setdefault(k[:k.index(b" ")], len(number)) for k in keys])
        kinds, good = np.bincount(first), np.bincount(first, t > 0).astype("<i8")
        names = list(number)
        for to, k in cut(hashes(names) % buckets, np.arange(len(names))):
            out.append((None, to, False, squeeze(kinds[k], good[k]), 0, zlib.compress(b"\n".join([names[j] for j in k.tolist()]), 1)))
        return pa.table([pa.array(x, y) for x, y in zip(zip(*out), [
            pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary()])],
            names=["block", "bucket", "pairs", "body", "kinds", "words"])

    return materialize(messages(coded, buckets, True).groupBy("bucket").applyInArrow(run, REPLY), "pair-totals")


def word_totals(coded: DataFrame, pairs: DataFrame, buckets: int) -> DataFrame:
    """Replies with the words' totals and followers; ``kinds`` counts a bucket's distinct words once."""
    told = pairs.where("block IS NULL").selectExpr("bucket", "block", "words AS body", "body AS counts")

    def run(table):
        import pyarrow as pa
        import pyarrow.compute as pc

        asks = table.filter(pc.is_valid(table.column("block")))
        told = table.filter(pc.is_null(table.column("block")))
        at, _, total, keys = _answers(asks, 4)
        number = {k: i for i, k in enumerate(keys)}
        total += _followers(told, number)
        bucket, out = table.column("bucket")[0].as_py(), []
        distinct = len(keys) - (b"" in number)
        for j, (block, k) in enumerate(zip(asks.column("block").to_pylist(), at)):
            out.append((block, bucket, False, squeeze(*(x[k] for x in total)), 0 if j else distinct, None))
        return pa.table([pa.array(x, y) for x, y in zip(zip(*out), [
            pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.binary()])],
            names=["block", "bucket", "pairs", "body", "kinds", "words"])

    return materialize(messages(coded, buckets, False).unionByName(told).groupBy("bucket").applyInArrow(run, REPLY), "word-totals")


def _followers(told, number: dict):
    """Distinct followers (all, target) of the words in ``number``."""
    import zlib

    import numpy as np

    out = np.zeros((2, len(number)), "<i8")
    for body, counts in zip(told.column("body").to_pylist(), told.column("counts").to_pylist()):
        at = [number[w] for w in zlib.decompress(body).split(b"\n")]  # distinct within a message
        out[:, at] += expand(counts, "<i8", 2)
    return [out[0], out[1]]


def losses(pair, follow, kinds, word, total: int, size: int):
    """Bits of pairs: own count, count and kinds of the first word's followers, count of the second word."""
    import numpy as np

    uni = (word + 1) / (total + size)
    seen = np.maximum(follow, 1)
    p = np.where(follow > 0, (np.maximum(pair - DISCOUNT, 0) + DISCOUNT * kinds * uni) / seen, uni)
    return -np.log2(p)


def cross_entropy_difference(docs: DataFrame, labels: DataFrame, vocabulary: int | None = None) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) of every document; losses in bits a word.

    All words are told apart; with ``vocabulary`` only the ``vocabulary`` - 1
    most frequent, the rest being one unknown word.  A null text or one without
    words has 0 words and null losses and score.  With no good label the target
    model is uniform.  Null ids are scored, never labelled; repeated rows are
    kept and counted each; an empty table gives an empty result; other columns
    are ignored, whatever their names; very long texts are counted and scored
    whole.
    """
    total = id_and_text(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-int(total) // BUCKET_BYTES))
    coded = blocks(docs, labels, None if vocabulary is None else frequent_words(docs, vocabulary - 1))
    pairs = pair_totals(coded, buckets)
    words = word_totals(coded, pairs, buckets)
    size = vocabulary or (words.agg(F.sum("kinds")).first()[0] or 0) + 1
    kind = coded.schema["ids"].dataType.elementType.simpleString()

    sums = coded.select("n", "target").mapInArrow(_sums, "n long, t long").agg(F.sum("n"), F.sum("t")).first()
    n_all, n_good = (x or 0 for x in sums)

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        held = Block(*(left.column(k)[0].as_py() for k in ("n", "target", "coded", "words")))
        pair = [held.all.copy(), held.good.copy()]
        stats = np.zeros((6, len(held.words)), np.int64)
        parts = {}
        for bucket, is_pair, body in zip(*(right.column(k).to_pylist() for k in ("bucket", "pairs", "body"))):
            parts[is_pair, bucket] = body
        for bucket, at in held.by_bucket(buckets):
            if (body := parts.get((True, bucket))) is not None:
                more, c, t = expand(body, "<i8", 3)
                pair[0][at[more]], pair[1][at[more]] = c, t
        for bucket, at in cut(held.hash % buckets, np.arange(len(held.words))):
            stats[:, at] = expand(parts[False, bucket], "<i8", 6)
        word_all, word_good, follow_all, follow_good, kinds_all, kinds_good = stats
        doc, u, w = np.repeat(np.arange(len(held.n)), held.n), held.u, held.w
        out = []
        for own, follow, kinds, word, n in ((pair[1], follow_good, kinds_good, word_good, n_good),
                                            (pair[0], follow_all, kinds_all, word_all, n_all)):
            bits = losses(own, follow[u], kinds[u], word[w], n, size)
            mean = np.bincount(doc, bits[held.at], len(held.n)) / np.maximum(held.n, 1)
            out.append(pa.array(mean, pa.float64(), mask=held.n == 0))
        return pa.table([left.column("ids").combine_chunks().flatten(), pa.array(held.n.astype(np.int64)), *out],
                        names=["doc_id", "n_words", "target_loss", "background_loss"])

    replies = pairs.where("block IS NOT NULL").unionByName(words).select("block", "bucket", "pairs", "body")
    out = coded.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, n_words long, target_loss double, background_loss double")
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def _sums(batches):
    """Words of all and of target documents."""
    import numpy as np
    import pyarrow as pa

    for b in batches:
        both = [(expand(n, "<i4")[0], expand(t, "u1")[0]) for n, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([int(n.sum()) for n, _ in both], pa.int64()),
                                          pa.array([int(n[t > 0].sum()) for n, t in both], pa.int64())], names=["n", "t"])


def duck_sql() -> str:
    """DuckDB twin over the views ``documents`` and ``labels``: every word of the corpus has its own id, -1 starts
    a text, and one id beside the words stands for unseen ones."""
    size = "(SELECT count(*) + 1 FROM vocab)"

    def model(name: str, rows: str) -> str:
        return f"""
{name}_pair AS (SELECT u, w, count(*) AS c FROM {rows} GROUP BY u, w),
{name}_uni AS (SELECT v.w, (coalesce(sum(c), 0) + 1) / ((SELECT count(*) FROM {rows}) + {size} * 1.0) AS p
               FROM (SELECT id AS w FROM vocab) v LEFT JOIN {name}_pair USING (w) GROUP BY v.w),
{name}_seen AS (SELECT u, sum(c) AS n, count(*) AS kinds FROM {name}_pair GROUP BY u)"""

    def loss(name: str) -> str:
        return (f"-log2(CASE WHEN {name}_seen.n IS NULL THEN {name}_uni.p ELSE (greatest(coalesce({name}_pair.c, 0) - {DISCOUNT}, 0) "
                f"+ {DISCOUNT} * {name}_seen.kinds * {name}_uni.p) / {name}_seen.n END)")
    joins = " ".join(f"JOIN {m}_uni ON {m}_uni.w = s.w LEFT JOIN {m}_seen ON {m}_seen.u = s.u "
                     f"LEFT JOIN {m}_pair ON {m}_pair.u = s.u AND {m}_pair.w = s.w" for m in ("t", "b"))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS ws FROM documents),
x AS (SELECT rid, doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
vocab AS MATERIALIZED (SELECT word, row_number() OVER (ORDER BY word) AS id FROM x GROUP BY word),
ids AS (SELECT rid, doc_id, i, id AS w FROM x JOIN vocab USING (word)),
s AS MATERIALIZED (SELECT rid, doc_id, coalesce(lag(w) OVER (PARTITION BY rid ORDER BY i), -1) AS u, w FROM ids),
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
st AS (SELECT s.* FROM s JOIN good USING (doc_id)),{model("t", "st")},{model("b", "s")},
m AS (SELECT s.rid, avg({loss("t")}) AS target_loss, avg({loss("b")}) AS background_loss, count(*) AS n
      FROM s {joins} GROUP BY s.rid)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, target_loss, background_loss, target_loss - background_loss AS score
FROM d LEFT JOIN m USING (rid)"""
