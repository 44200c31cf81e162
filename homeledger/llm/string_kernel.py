"""Toxicity by a subsequence-kernel support vector machine with Nyström landmarks (operator 7).

A sentence is a bag of units: its lower-cased words, letters only, and runs of
single letters joined ("i d i o t").  The kernel between two units sums, over
all subsequences of four characters, decay ** (characters spanned in one) times
the same in the other, with at most ``SPAN - 4`` foreign characters in between,
so a gapped or padded insult stays close to the plain one; it is scaled to 1 for
a unit with itself.  Units are mapped to the landmarks' Nyström space
(K_mm^-1/2 k_m(u)); a squared-hinge linear SVM is trained there.

Labels belong to texts, so training is multiple-instance: the units of a
toxic text that score highest are positive examples, those of a clean text and
a draw of its other units negative ones; scoring and training take turns.  A text scores as its
worst unit does, through a logistic curve fitted on the training texts and on
padded forms of their insults.

As the decision is linear in the subsequences, landmarks, Nyström map and SVM
weights collapse into one weight per subsequence (exactly): a task scores each
distinct unit once from a table bounded by the number of landmarks.

Training reads at most ``max_toxic`` + ``max_clean`` labelled texts (expected;
a documented bound of the classifier), and takes units of at most
``EXAMPLE_LETTERS`` letters as examples; every text is scored whole.  Units are
read in runs of ``RUN_CHARS`` characters whose sums add up, so a text without
white space needs no more memory than any other.
"""

from __future__ import annotations

import itertools
import re
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homeledger.llm.shared import fresh_name, id_bucket, ship, tidy
from homeledger.session import materialize

SPAN = 6
DECAY = 0.7
LANDMARKS = 320
MAX_TOXIC = 2000
MAX_CLEAN = 4000
RUN_CHARS = 50_000
EXAMPLE_LETTERS = 64
RESULT = "score double, predicted int"
_PATTERNS = [(0, *p) for p in itertools.combinations(range(1, SPAN), 3)]
_NOT_LETTER = re.compile(r"[\W\d_]+")


def unit_of(word: str) -> str:
    """Letters of a lower-cased word."""
    return word if word.isalpha() else _NOT_LETTER.sub("", word)


def units(text: str) -> set[str]:
    """Distinct lower-cased words of a text (raw), and runs of three or more single letters joined."""
    words = text.lower().split()
    out = set(words)
    if sum(len(w) == 1 or len(w) == 2 and not w.isalpha() for w in out) >= 2:
        run = []
        for w in [*words, "  "]:
            u = unit_of(w)
            if len(u) == 1 and w != "  ":
                run.append(u)
            else:
                if len(run) >= 3:
                    out.add("".join(run))
                run = []
    return out


def example_units(text: str) -> list[str]:
    """Sorted distinct units of a text, short enough to learn from."""
    return sorted(u for u in {unit_of(w) for w in units(text)} if 0 < len(u) <= EXAMPLE_LETTERS)


def runs_of_units(words: list[str], chars: int):
    """(number of the first unit, units, None) of at most ``chars`` characters each.

    A longer unit comes alone, in pieces (its number, [piece], starts) that
    share ``SPAN`` - 1 characters; only the first ``starts`` characters of a
    piece begin subsequences, so each subsequence of the unit falls in one.
    """
    import numpy as np

    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
    lo = 0
    while lo < len(words):
        size = len(words[lo])
        if size > chars:
            for at in range(0, size, chars):
                yield lo, [words[lo][at:at + chars + SPAN - 1]], min(chars, size - at)
            lo += 1
        else:
            hi = int(np.searchsorted(ends, ends[lo] - size + chars, "right"))
            yield lo, words[lo:hi], None
            lo = hi


def subsequences(words: list[str], starts: int | None = None):
    """(unit number, subsequence code, weight) of every gapped four-character subsequence, and norms.

    Callers mark the start of a unit with ``^``.  Characters beyond the basic
    plane count by their low 16 bits.  With ``starts``, only that many first
    characters (of a single word) begin subsequences.
    """
    import numpy as np

    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32) if words else np.empty(0, np.uint32)
    flat = flat & np.uint32(0xFFFF)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(flat))
    if starts is not None:
        at, end = at[:starts], end[:starts]
    who, code, weight = [], [], []
    for p in _PATTERNS:
        i = at[at + p[3] < end]
        c = flat[i].astype(np.uint64)
        for k in p[1:]:
            c = (c << np.uint64(16)) | flat[i + k]
        who.append(owner[i])
        code.append(c)
        weight.append(np.full(len(i), DECAY ** (p[3] + 1)))
    who, code, weight = np.concatenate(who), np.concatenate(code), np.concatenate(weight)
    norm = np.sqrt(np.bincount(who, weight * weight, len(words)))
    return who, code, weight, np.where(norm > 0, norm, 1.0)


class SubsequenceScorer:
    """Collapsed decision function: one weight per subsequence, then a logistic curve per text."""

    def __init__(self, codes, weights, bias: float, slope: float, shift: float):
        self.codes, self.weights, self.bias, self.slope, self.shift = codes, weights, bias, slope, shift
        self._index()

    def _index(self):
        import numpy as np

        self.bits = 22
        slot = self._slot(self.codes)
        self.first = np.full(1 << self.bits, -1, np.int32)
        self.first[slot] = np.arange(len(self.codes), dtype=np.int32)
        rest = self.first[slot] != np.arange(len(self.codes))
        self.rest = self.codes[rest]
        self.rest_weights = self.weights[rest]

    def _slot(self, codes):
        import numpy as np

        return (codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "first"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._index()

    def decide(self, words: list[str]):
        """SVM decision value of each unit."""
        import numpy as np

        if not words or not len(self.codes):
            return np.full(len(words), self.bias)
        total, square = np.zeros(len(words)), np.zeros(len(words))
        for lo, part, starts in runs_of_units(["^" + w for w in words], RUN_CHARS):
            own = slice(lo, lo + len(part))
            who, code, weight, norm = subsequences(part, starts)
            square[own] += norm * norm if starts is None else weight @ weight
            at = self.first[self._slot(code)]
            hit = at >= 0
            at, code, who, weight = at[hit], code[hit], who[hit], weight[hit]
            same = self.codes[at] == code
            value = np.where(same, self.weights[at], 0.0)
            if len(self.rest):
                other = np.flatnonzero(~same)
                i = np.minimum(np.searchsorted(self.rest, code[other]), len(self.rest) - 1)
                value[other] = np.where(self.rest[i] == code[other], self.rest_weights[i], 0.0)
            total[own] += np.bincount(who, weight * value, len(part))
        return self.bias + total / np.where(square > 0, np.sqrt(square), 1.0)

    def worst(self, texts: list[str]):
        """Highest decision value among the units of each text (that of no unit for an empty text)."""
        import numpy as np

        bags = [units(t) for t in texts]
        raw = list(set().union(*bags)) if bags else []
        clean = [unit_of(w) for w in raw]
        letters = sorted(set(clean))
        value = dict(zip(letters, self.decide(letters).tolist()))
        by_raw = {w: value[u] for w, u in zip(raw, clean)}
        return np.array([max(map(by_raw.__getitem__, b), default=self.bias) for b in bags], float)

    def score(self, texts: list[str]):
        import numpy as np

        z = self.slope * self.worst(texts) + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _hinge_svm(x, y, weight, ridge: float = 1e-3, rounds: int = 30):
    """Primal L2 SVM with squared hinge loss by Newton steps; returns (w, bias)."""
    import numpy as np

    x1 = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x1.shape[1])
    reg = np.full(x1.shape[1], ridge)
    reg[-1] = 1e-9
    total = weight.sum()
    active = None
    for _ in range(rounds):
        now = y * (x1 @ w) < 1
        if active is not None and (now == active).all():
            break
        active = now
        xa, ya, wa = x1[active], y[active], weight[active] / total
        h = (xa * wa[:, None]).T @ xa + np.diag(reg)
        w = np.linalg.solve(h, (xa * wa[:, None]).T @ ya)
    return w[:-1], w[-1]


def _logistic(x, y, ridge: float = 1e-4, rounds: int = 50):
    """Platt curve: slope and shift of a logistic regression on one value."""
    import numpy as np

    a, b = 1.0, 0.0
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -60, 60)))
        g = np.array([((p - t) * x).sum() + ridge * a, (p - t).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * x * x).sum() + ridge, (s * x).sum()], [(s * x).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _vectors(words: list[str], codes):
    """Sparse normalised subsequence vectors over the sorted ``codes``: (row, column, value)."""
    import numpy as np

    who, code, weight, norm = subsequences(["^" + w for w in words])
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    hit = codes[at] == code
    return who[hit], at[hit], weight[hit] / norm[who[hit]]


def _kernel(words: list[str], codes, marks):
    """Kernel of each word with the landmarks, whose vectors are the columns of ``marks``."""
    import numpy as np

    out = np.zeros((len(words), marks.shape[1]))
    for lo in range(0, len(words), 1000):
        row, col, val = _vectors(words[lo:lo + 1000], codes)
        order = np.argsort(row, kind="stable")
        row, col, val = row[order], col[order], val[order]
        if len(row):
            first = np.flatnonzero(np.diff(row, prepend=-1))
            out[lo + row[first]] = np.add.reduceat(marks[col] * val[:, None], first, axis=0)
    return out


def padded(word: str) -> list[str]:
    """The word with one foreign letter at each inner place (letters in turn), and with each letter doubled."""
    turn = "xaiueonrtsl"
    return [word[:i] + turn[(i + len(word)) % len(turn)] + word[i:] for i in range(1, len(word))] + [
        word[:i] + word[i - 1:] for i in range(1, len(word))]


def fit(witness: dict[str, int], negative: dict[str, int], landmarks: int = LANDMARKS) -> SubsequenceScorer:
    """SVM in the landmarks' Nyström space; values are how often each unit was drawn.

    Landmarks: the most frequent witnesses (half) and negative units (half).
    Padded forms of the landmark witnesses are positive examples too, sharing
    the weight of the plain form, unless they are words of clean texts.
    """
    import numpy as np

    for u in sorted(witness, key=lambda u: (-witness[u], u))[: landmarks // 2]:
        if negative.get(u, 0) < witness[u]:
            more = [v for v in padded(u) if v not in negative and v not in witness]
            witness = witness | {v: witness[u] / len(more) for v in more}
    pos = sorted(witness, key=lambda u: (-witness[u], u))
    neg = sorted(negative, key=lambda u: (-negative[u], u))
    marks = pos[: landmarks // 2]
    known = set(marks)
    marks += [u for u in neg if u not in known][: landmarks - len(marks)]
    codes = np.unique(subsequences(["^" + u for u in marks])[1])
    if not len(codes) or not pos or not neg:
        return SubsequenceScorer(np.empty(0, np.uint64), np.empty(0), 0.0, 1.0, 0.0)
    dense = np.zeros((len(codes), len(marks)))
    row, col, val = _vectors(marks, codes)
    np.add.at(dense, (col, row), val)
    size, vec = np.linalg.eigh(dense.T @ dense + 1e-6 * np.eye(len(marks)))
    root = (vec / np.sqrt(np.clip(size, 1e-6, None))) @ vec.T
    x = _kernel(pos + neg, codes, dense) @ root
    y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
    times = np.array([*(witness[u] for u in pos), *(negative[u] for u in neg)], float)
    times[y > 0] /= times[y > 0].sum()
    times[y < 0] /= times[y < 0].sum()
    w, bias = _hinge_svm(x, y, times)
    return SubsequenceScorer(codes, dense @ (root @ w), float(bias), 1.0, 0.0)


def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, max_toxic: int, max_clean: int) -> DataFrame:
    """(text, toxic) of a bounded draw of labelled texts, written once."""
    own = (labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(learn))
    n = {r["toxic"]: r["count"] for r in own.groupBy("toxic").count().collect()}
    share = {t: min(1.0, most / n[t]) if n.get(t) else 0.0 for t, most in ((1, max_toxic), (0, max_clean))}
    draw = F.expr("(xxhash64(doc_id) & 2147483647L) / 2147483648D")
    # max_toxic + max_clean rows are expected, which bounds the broadcast
    drawn = own.where(draw < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return materialize(text.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "text")
                       .agg(F.max("toxic").alias("toxic")).select("text", "toxic"), "toxic-sample")


def runs_of(batch, rows: int):
    """Slices of at most ``rows`` rows of an Arrow batch."""
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def telling_subsequences(sample: DataFrame, most: int = 20_000) -> SubsequenceScorer:
    """First scorer: subsequences found in a larger share of toxic than of clean texts, by a bound on the ratio."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        tidy()
        for b in (part for whole in batches for part in runs_of(whole, 100)):
            toxic = np.asarray(b.column(1).to_pylist())
            codes, label = [], []
            for text, t in zip(b.column(0).to_pylist(), toxic):
                own = np.unique(np.concatenate([np.empty(0, np.uint64)] + [
                    np.unique(subsequences(part, starts)[1])
                    for _, part, starts in runs_of_units(["^" + u for u in example_units(text)], RUN_CHARS)]))
                codes.append(own)
                label.append(np.full(len(own), t == 1))
            if codes:
                got, back = np.unique(np.concatenate(codes), return_inverse=True)
                pos = np.bincount(back, np.concatenate(label), len(got)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got.view(np.int64)), pa.array(pos), pa.array(np.bincount(back, minlength=len(got)) - pos)],
                    names=["code", "pos", "neg"])
                del got, back, pos, codes, label
        tidy()

    n1, n0 = sample.agg(F.expr("count_if(toxic = 1)"), F.expr("count_if(toxic = 0)")).first()
    # Lower confidence bound of the log ratio of the two shares: frequent and pure subsequences lead.
    pos, neg = F.col("pos") + 0.5, F.col("neg") + 0.5
    z = F.log(pos / (n1 + 1.0)) - F.log(neg / (n0 + 1.0)) - 1.64 * F.sqrt(1 / pos + 1 / neg)
    top = (sample.mapInArrow(count, "code long, pos long, neg long").groupBy("code")
           .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).select("code", z.alias("z"))
           .where("z > 0").orderBy(F.desc("z"), "code").limit(most).toPandas())
    codes = top["code"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(codes)
    return SubsequenceScorer(codes[order], top["z"].to_numpy()[order], 0.0, 1.0, 0.0)


def examples(sample: DataFrame, scorer: SubsequenceScorer, hard: int = 3, usual: int = 4):
    """(witnesses, negatives): the ``hard`` worst units of each text, and of clean ones ``usual``
    others drawn by their checksum."""

    def pick(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for text, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = example_units(text)
                if own:
                    value = dict(zip(own, scorer.decide(own).tolist()))
                    out += [(u, t) for u in sorted(own, key=lambda u: -value[u])[:hard]]
                    if t == 0:
                        out += [(u, 0) for u in sorted(own, key=lambda u: zlib.crc32(u.encode()))[:usual]]
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in out], pa.string()),
                                              pa.array([t for _, t in out], pa.int32())], names=["unit", "toxic"])

    got = (sample.mapInArrow(pick, "unit string, toxic int").groupBy("unit", "toxic").count().collect())
    return ({r["unit"]: r["count"] for r in got if r["toxic"] == 1},
            {r["unit"]: r["count"] for r in got if r["toxic"] == 0})


def train(docs: DataFrame, labels: DataFrame, learn: Column, max_toxic: int = MAX_TOXIC,
          max_clean: int = MAX_CLEAN, landmarks: int = LANDMARKS, rounds: int = 2) -> SubsequenceScorer:
    """Scorer fitted on labelled texts whose id passes ``learn``.

    With no toxic or no clean text to learn from, every text gets the same
    score (the smoothed share of toxic labels, 1/4 without any).
    """
    import numpy as np

    sample = labelled_sample(docs, labels, learn, max_toxic, max_clean)
    n1, n0 = sample.agg(F.expr("count_if(toxic = 1)"), F.expr("count_if(toxic = 0)")).first()
    if not n1 or not n0:
        share = (n1 + 1) / (n1 + n0 + 4)
        return SubsequenceScorer(np.empty(0, np.uint64), np.empty(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    scorer = telling_subsequences(sample)
    negative: dict[str, int] = {}
    for _ in range(rounds):
        witness, more = examples(sample, scorer)
        for u, k in more.items():
            negative[u] = max(k, negative.get(u, 0))
        scorer = fit(witness, negative, landmarks)
    worst = scorer

    def best(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(worst.worst(b.column(0).to_pylist())),
                                              pa.array(b.column(1).to_pylist(), pa.int32())], names=["x", "y"])

    got = sample.mapInArrow(best, "x double, y int").toPandas()
    # spelled-around insults are rare in the labels: a third as many padded witnesses stand for them
    forms = sorted({v for u in sorted(witness, key=lambda u: (-witness[u], u))[: landmarks // 2]
                    if negative.get(u, 0) < witness[u] for v in padded(u) if v not in negative},
                   key=lambda v: zlib.crc32(v.encode()))[: n1 // 3]
    slope, shift = _logistic(np.concatenate([got["x"], scorer.decide(forms)]), np.concatenate([got["y"], np.ones(len(forms))]))
    return SubsequenceScorer(scorer.codes, scorer.weights, scorer.bias, slope, shift)


def predictor(spark, scorer: SubsequenceScorer):
    """Column function: text -> struct of :data:`RESULT`."""
    load = ship(spark, scorer)

    def run(batches):
        import numpy as np
        import pandas as pd

        tidy()
        model = load()
        for texts in batches:
            score, part, n = [], [], 0
            for t in texts:
                t = t if isinstance(t, str) else ""
                if part and n + len(t) > 1_000_000:
                    score.append(model.score(part))
                    part, n = [], 0
                part.append(t)
                n += len(t)
            if part:
                score.append(model.score(part))
            score = np.concatenate(score) if score else np.empty(0)
            yield pd.DataFrame({"score": score, "predicted": (score >= 0.5).astype("int32")})
        del model
        tidy()

    return F.pandas_udf(run, RESULT, F.PandasUDFType.SCALAR_ITER)


def learnable() -> Column:
    """Ids that may be learned from: crc32 of the id modulo 5 is not 0."""
    return F.coalesce(id_bucket(F.col("doc_id"), 5) != 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    ``held_out``: crc32 of the id modulo 5 is 0 (false for a null id); labels
    of such rows teach nothing, nor do null labels.  Of several labels of one
    id the highest counts.  A null or empty text, or one without a letter, gets
    the score of a text whose worst unit is neutral.  Repeated rows are kept;
    an empty table gives an empty result; other columns are ignored, whatever
    their names; very long texts are read whole.
    """
    call = predictor(docs.sparkSession, train(docs, labels, learnable(), **options))
    held = F.coalesce(id_bucket(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return (docs.select("doc_id", held, call("text").alias("p"))
            .select("doc_id", "held_out", "p.score", "p.predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """Rows of ``docs``, all columns, that score below ``threshold``.

    A null or empty text, or one without a letter, scores as in
    :func:`toxicity`.  Repeated rows are scored alike and each kept or dropped;
    a score equal to ``threshold`` drops the row; an empty table gives an empty
    one; columns of any name are carried along; very long texts are read whole.
    """
    name = fresh_name(docs, "toxicity")
    call = predictor(docs.sparkSession, train(docs, labels, learnable(), **options))
    return docs.withColumn(name, call("text")).where(F.col(name)["score"] < threshold).drop(name)
