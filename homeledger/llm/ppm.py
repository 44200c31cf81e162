"""Language identification by prediction by partial matching (operator 3).

Per language, byte counts of every context of 0 to ``ORDER`` bytes form a
variable-order context tree.  In a context seen n times with d distinct next
bytes, a byte seen c times costs -log2(c / (n + d)) bits and the escape to the
next shorter context -log2(d / (n + d)); below the empty context all 256 bytes
cost 8 bits; a context never seen is skipped at no cost.  The statistics are
frozen after training, so the cost of a byte depends on the last ``ORDER``
bytes only and a text's code length is an exact sum over all its bytes: tasks
look the costs of known byte strings up in tables and work out the others from
the trees.  The language with the shortest code (plus the cost of its share of
the training texts) is predicted.

Training reads a sample of labelled texts, whole, whose expected size is at
most ``sample_bytes`` per language; the trees are bounded by it, which bounds
the broadcast.  Everything else covers all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import fresh_name, id_bucket, ship, tidy

ORDER = 3
SAMPLE_BYTES = 2_000_000
RUN_BYTES = 1_000_000
UNKNOWN = "und"
RESULT = "lang_pred string, score double, bits_per_byte double"


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _grams(texts: list[bytes]):
    """(ORDER + 1)-byte strings ending at every byte of the texts, as integers, and each text's length."""
    import numpy as np

    pad = b"\0" * ORDER
    buf = np.frombuffer(pad + pad.join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.ones(len(buf), bool)
    first = np.concatenate([[0], np.cumsum(sizes + ORDER)[:-1]]).astype(np.int64)
    for k in range(ORDER):
        at[first + k] = False
    at[:ORDER] = False
    gram = buf.astype(np.uint32)
    code = gram.copy()
    for k in range(1, ORDER + 1):
        code[k:] |= gram[:-k] << np.uint32(8 * k)
    return code[at], sizes


class ContextTrees:
    """Frozen context trees of all languages."""

    def __init__(self, langs: list[str], prior_bits, counts):
        """``counts``: per language, per order k, (sorted (k+1)-byte codes, their counts)."""
        import numpy as np

        self.langs, self.prior_bits = langs, np.asarray(prior_bits, float)
        self.trees = []
        for per_order in counts:
            tree = []
            for codes, n in per_order:
                ctx, start = np.unique(codes >> np.uint32(8), return_index=True)
                total = np.add.reduceat(n, start) if len(n) else n
                distinct = np.diff(np.append(start, len(codes)))
                tree.append((codes, n, ctx, total, distinct))
            self.trees.append(tree)
        known = [per_order[ORDER][0] for per_order in counts]
        known = np.unique(np.concatenate(known)) if known else np.empty(0, np.uint32)
        self.cost = self.bits(known)
        # Bytes -> classes; two table steps lead from the classes of a string to its row of costs.
        used = np.unique(known.view(np.uint8)) if len(known) else np.empty(0, np.uint8)
        self.classes = np.full(256, len(used), np.int32)
        self.classes[used] = np.arange(len(used), dtype=np.int32)
        self.n_classes = a = len(used) + 1
        cls = [self.classes[(known >> np.uint32(8 * k)) & np.uint32(255)] for k in range(ORDER, -1, -1)]
        head = (cls[0] * a + cls[1]) * a + cls[2]
        heads = np.unique(head)
        self.head_row = np.full(a ** ORDER, -1, np.int32)
        self.head_row[heads] = np.arange(len(heads), dtype=np.int32)
        self.rows = np.full(max(1, len(heads)) * a, -1, np.int32)
        self.rows[self.head_row[head] * a + cls[3]] = np.arange(len(known), dtype=np.int32)

    def bits(self, codes):
        """Code length of the last byte of each (ORDER + 1)-byte string, per language."""
        import numpy as np

        def find(keys, values, wanted):
            if not len(keys):
                return np.zeros(len(wanted))
            i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[i] == wanted, values[i], 0).astype(float)

        out = np.empty((len(codes), len(self.langs)))
        for j, tree in enumerate(self.trees):
            cost = np.full(len(codes), 8.0)
            for k, (grams, n, ctx, total, distinct) in enumerate(tree):
                own = codes & np.uint32((1 << 8 * (k + 1)) - 1)
                c, t, d = find(grams, n, own), find(ctx, total, own >> np.uint32(8)), find(ctx, distinct, own >> np.uint32(8))
                with np.errstate(divide="ignore", invalid="ignore"):
                    cost = np.where(t == 0, cost, np.where(c > 0, np.log2((t + d) / c), np.log2((t + d) / d) + cost))
            out[:, j] = cost
        return out

    def code_lengths(self, texts: list[bytes]):
        """Bits of each text under each language (texts hold one byte or more).

        A text of over ``RUN_BYTES`` is read in runs that look ``ORDER`` bytes
        back; the bits of its runs add up.
        """
        out = self._run_lengths(*_grams([t[:RUN_BYTES] for t in texts]))
        for j, t in enumerate(texts):
            for lo in range(RUN_BYTES, len(t), RUN_BYTES):
                codes, sizes = _grams([t[lo - ORDER:lo + RUN_BYTES]])
                out[j] += self._run_lengths(codes[ORDER:], sizes - ORDER)[0]
        return out

    def _run_lengths(self, codes, sizes):
        """Bits of consecutive runs of (ORDER + 1)-byte strings, per language."""
        import numpy as np

        a, cls = self.n_classes, self.classes
        part = [cls[(codes >> np.uint32(8 * k)) & np.uint32(255)] for k in range(ORDER, -1, -1)]
        head = self.head_row[(part[0] * a + part[1]) * a + part[2]]
        row = np.where(head < 0, -1, self.rows[head * a + part[3]])
        table = self.cost
        if (miss := row < 0).any():
            new, back = np.unique(codes[miss], return_inverse=True)
            row[miss] = len(table) + back
            table = np.concatenate([table, self.bits(new)])
        return np.add.reduceat(table[row], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0)

    def predict(self, texts: list[str | None]):
        """(lang_pred, score, bits_per_byte) lists."""
        import numpy as np

        raw = [(t or "").lower().encode() for t in texts]
        lang, score, bpb = [UNKNOWN] * len(raw), [0.0] * len(raw), [None] * len(raw)
        if not self.langs:
            return lang, score, bpb
        todo = [i for i, t in enumerate(texts) if t and has_letter(t)]
        lo = 0
        while lo < len(todo):
            hi, n = lo, 0
            while hi < len(todo) and (hi == lo or n + len(raw[todo[hi]]) <= RUN_BYTES):
                n += len(raw[todo[hi]])
                hi += 1
            part = todo[lo:hi]
            bits = self.code_lengths([raw[i] for i in part])
            total = bits + self.prior_bits
            best = total.argmin(axis=1)
            low = total[np.arange(len(part)), best]
            share = 1 / np.exp2(np.maximum(low[:, None] - total, -1000)).sum(axis=1)
            for i, j, s, b in zip(part, best.tolist(), share.tolist(), bits[np.arange(len(part)), best].tolist()):
                lang[i], score[i], bpb[i] = self.langs[j], s, b / len(raw[i])
            lo = hi
        return lang, score, bpb


def train(docs: DataFrame, learn: Column, sample_bytes: int = SAMPLE_BYTES) -> ContextTrees:
    """Context trees from rows of ``docs`` where ``learn`` holds and text and lang are not null."""
    import numpy as np

    rows = docs.where(learn & F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    sizes = rows.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("b"), F.count("*").alias("n")).collect()
    sizes = {r["lang"]: (int(r["b"] or 0), r["n"]) for r in sizes}
    langs = sorted(k for k, (b, _) in sizes.items() if b)
    if not langs:
        return ContextTrees([], [], [])
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample_bytes / sizes[k][0]))])
    draw = F.expr("(xxhash64(doc_id, text) & 2147483647L) / 2147483648D")
    # repeated rows share one draw: each text counts once, so copies cannot swell the sample
    sample = rows.where(draw < share[F.col("lang")]).select("lang", "text").distinct()

    def count(batches):
        import pyarrow as pa

        for b in batches:
            by: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    by.setdefault(lang, []).append(text.lower().encode())
            for lang, texts in by.items():
                codes, _ = _grams(texts)
                for k in range(ORDER + 1):
                    codes_k, n = np.unique(codes & np.uint32((1 << 8 * (k + 1)) - 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(n)), pa.array([k] * len(n), pa.int32()),
                         pa.array(codes_k.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "k", "code", "n"])

    tree = (sample.mapInArrow(count, "lang string, k int, code long, n long")
            .groupBy("lang", "k", "code").agg(F.sum("n").alias("n")).toPandas())
    counts = []
    for lang in langs:
        own = tree[tree["lang"] == lang]
        per = []
        for k in range(ORDER + 1):
            x = own[own["k"] == k].sort_values("code")
            per.append((x["code"].to_numpy().astype(np.uint32), x["n"].to_numpy().astype(np.int64)))
        counts.append(per)
    n = np.array([sizes[k][1] for k in langs], float)
    return ContextTrees(langs, -np.log2(n / n.sum()), counts)


def predictor(spark, trees: ContextTrees):
    """Column function: text -> struct of :data:`RESULT`."""
    load = ship(spark, trees)

    def run(batches):
        import pandas as pd

        tidy()
        model = load()
        for texts in batches:
            lang, score, bpb = model.predict([t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang_pred": lang, "score": score, "bits_per_byte": pd.Series(bpb, dtype="float64")})
        del model
        tidy()

    return F.pandas_udf(run, RESULT, F.PandasUDFType.SCALAR_ITER)


def learnable(held_out_of: int = 4, held_out: int = 2) -> Column:
    """Rows whose id may be learned from (a null id may not)."""
    return F.coalesce(id_bucket(F.col("doc_id"), held_out_of) != held_out, F.lit(False))


def identify(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) of every document.

    ``held_out``: crc32 of the id modulo 4 is 2 (false for a null id); such
    rows, and rows with a null id, text or lang, teach nothing.  ``und`` with
    score 0: the text is null or has no letter, or there is nothing to learn
    from.  Ties go to the language first in the alphabet.  Repeated rows are
    kept; an empty table gives an empty result; other columns are ignored,
    whatever their names; very long texts are read whole.
    """
    docs = docs.select("doc_id", "text", "lang")
    call = predictor(docs.sparkSession, train(docs, learnable(), sample_bytes))
    held = F.coalesce(id_bucket(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out")
    return (docs.select("doc_id", held, call("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.bits_per_byte"))


def keep_identified(docs: DataFrame, min_score: float = 0.5, max_bits: float = 7.0,
                    sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is recognised.

    A text is rejected if it is null or has no letter, if no language holds at
    least ``min_score`` of the probability, or if even the best language codes
    it worse than ``max_bits`` a byte.  With nothing to learn from, every text
    with a letter is kept.  Ties between languages go to the first by name;
    repeated rows are judged alike and each kept or dropped; an empty table
    gives an empty one; columns of any name are carried along; very long texts
    are read whole, in runs.
    """
    trees = train(docs.select("doc_id", "text", "lang"), learnable(), sample_bytes)
    name = fresh_name(docs, "ppm")
    call = predictor(docs.sparkSession, trees)
    p = F.col(name)
    if not trees.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return (docs.withColumn(name, call("text"))
            .where((p["lang_pred"] != UNKNOWN) & (p["score"] >= min_score) & (p["bits_per_byte"] <= max_bits))
            .drop(name))
