import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from homeledger.llm import string_kernel as S
from homeledger.llm.queries import op7_string_kernel
from tests.llm.helpers import awkward, check_edges, clashing, rows_of


def brute_features(word):
    out = {}
    w = "^" + word
    for at in itertools.combinations(range(len(w)), 4):
        span = at[3] - at[0] + 1
        if span <= S.SPAN:
            out.setdefault("".join(w[i] for i in at), []).append(S.DECAY ** span)
    return out


def brute_kernel(a, b):
    fa, fb = brute_features(a), brute_features(b)
    norm = lambda f: np.sqrt(sum(x * x for v in f.values() for x in v)) or 1.0
    return sum(sum(fa[k]) * sum(fb[k]) for k in fa.keys() & fb.keys()) / norm(fa) / norm(fb)


def test_kernel_against_brute_force():
    words = ["stupid", "stxupid", "student", "a", "", "aaaaaaa", "ßtüpid"]
    codes = np.unique(S.subsequences(["^" + w for w in words])[1])
    dense = np.zeros((len(codes), len(words)))
    row, col, val = S._vectors(words, codes)
    np.add.at(dense, (col, row), val)
    got = S._kernel(words, codes, dense)
    want = [[brute_kernel(a, b) for b in words] for a in words]
    assert np.allclose(got, want)


def test_one_weight_per_subsequence_equals_nystrom_svm():
    witness = {"stupid": 5, "moron": 4, "idiot": 3}
    negative = {w: 2 for w in ("student", "morning", "radio", "house", "street", "stupor", "period")}
    scorer = S.fit(witness, negative, landmarks=10)
    assert all(scorer.decide([w])[0] > 0 for w in witness) and all(scorer.decide([w])[0] < 0 for w in negative)
    table = dict(zip(scorer.codes.tolist(), scorer.weights.tolist()))
    for word in ("stuupid", "mo", "tree", "moxron"):
        who, code, weight, norm = S.subsequences(["^" + word])
        want = scorer.bias + sum(table.get(int(c), 0.0) * x for c, x in zip(code, weight)) / norm[0]
        assert np.isclose(scorer.decide([word])[0], want)


def test_units_join_spelled_out_words():
    assert "idiot" in S.units("you i d i o t there") and "idiot" in S.units("I. D. I. O. T.")
    assert "ab" not in S.units("a b") and S.unit_of("st*u-p1id") == "stupid"


def test_runs_of_long_units_add_up(monkeypatch):
    scorer = S.fit({"stupid": 5, "moron": 4}, {"student": 2, "morning": 2, "radio": 1}, landmarks=5)
    rng = np.random.default_rng(2)
    words = ["stupid", "", "a", "".join(rng.choice(list("stupidmorn"), 700)), "moron", "x" * 33]
    whole = scorer.decide(words)
    for chars in (1, 3, 7, 64, 1000):
        monkeypatch.setattr(S, "RUN_CHARS", chars)
        assert np.allclose(scorer.decide(words), whole, rtol=1e-12, atol=1e-12)


def test_memory_on_a_text_without_white_space():
    import tracemalloc

    scorer = S.fit({"stupid": 5, "moron": 4}, {"student": 2, "morning": 2, "radio": 1}, landmarks=5)
    text = "".join(np.random.default_rng(3).choice(list("stupidmornxyz"), 10_000_000))
    tracemalloc.start()
    got = scorer.score([text, "a student"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.isfinite(got).all() and peak < 300e6


def test_one_long_unit_does_not_break_training(spark):
    docs, labels = learned(spark)
    long_unit = spark.createDataFrame([(1000, "stupid" * 200_000, "en", "s", 0), (1001, "house" * 200_000, "en", "s", 0)], docs.schema)
    more = labels.unionByName(spark.createDataFrame([(1000, 1, 1), (1001, 1, 0)], labels.schema))
    got = {r["doc_id"]: r["predicted"] for r in S.toxicity(docs.unionByName(long_unit), more).collect()}
    assert len(got) == 402 and all(got[i] == int(i % 5 == 0) for i in range(400)) and got[1001] == 0


def learned(spark):
    words = "the house stands near river and green hills where people walk slowly every morning while birds sing".split()
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(400):
        text = list(rng.choice(words, 25))
        bad = i % 5 == 0
        if bad:
            text.insert(int(rng.integers(25)), str(rng.choice(["stupid", "moron", "worthless"])))
        rows.append((i, " ".join(text), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_plain_and_gapped_insults(spark):
    docs, labels = learned(spark)
    got = S.toxicity(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(r["predicted"] == r["toxic"] == int(r["score"] >= 0.5) for r in got)
    scorer = S.train(docs, labels, S.learnable())
    bad = scorer.score([f"the house stands near {w} river" for w in ("stupid", "s t u p i d", "st*upid", "STUPID!", "m.o.r.o.n")])
    good = scorer.score(["the house stands near the river", "", "1 2 3", "students walk every morning"])
    assert (bad >= 0.5).all() and (good < 0.5).all()


def test_held_out_labels_teach_nothing(spark):
    docs, labels = learned(spark)
    wrong = labels.withColumn("toxic", F.when(S.learnable(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    assert rows_of(S.toxicity(docs, wrong)) == rows_of(S.toxicity(docs, labels))


def test_whole_table(spark):
    """Held-out ranking on the small table, which holds few toxic texts to learn from."""
    sf = "/root/testdata/sf0.01"
    got = op7_string_kernel(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    held = got[got.held_out]
    rank = held.score.rank()
    n1 = (held.toxic == 1).sum()
    auc = (rank[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / n1 / (len(held) - n1)
    assert auc > 0.75


def test_edges(spark):
    docs, labels = learned(spark)
    both = lambda d: S.toxicity(d, labels)
    check_edges(spark, both, ["doc_id", "held_out", "score", "predicted"])
    nulls = spark.createDataFrame([(4, None, None), (None, 1, 1), (5, 1, 0), (5, 1, 0)], labels.schema)
    same = {r["score"] for r in S.toxicity(awkward(spark), nulls).collect()}
    assert len(same) == 1
    kept = S.keep_clean(clashing(docs), labels)
    assert kept.columns == clashing(docs).columns and kept.count() == 320
