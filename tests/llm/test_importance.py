import numpy as np

from homeledger.llm import importance as I
from homeledger.llm.queries import op4_importance
from homeledger.llm.wordhash import pair_hashes, word_hashes
from tests.llm.helpers import SF, awkward, check_edges


def one_word_hash(word):
    return int(word_hashes([word])[1][0])


def test_hashes_do_not_depend_on_place():
    texts = [b"ab c ab", b"", b"  c\nab ", b"x" * 500, b" \t"]
    owner, h = word_hashes(texts)
    words = [(i, w) for i, t in enumerate(texts) for w in t.split()]
    assert owner.tolist() == [i for i, _ in words]
    assert h.tolist() == [one_word_hash(w) for _, w in words]
    pairs = [(i, t.split()[k:k + 2]) for i, t in enumerate(texts) for k in range(len(t.split()) - 1)]
    owner2, h2 = pair_hashes(owner, h)
    assert owner2.tolist() == [i for i, _ in pairs]
    assert h2.tolist() == [int(pair_hashes(*word_hashes([b" ".join(p)]))[1][0]) for _, p in pairs]


def test_weights_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    raw, target, own = np.ones(I.BUCKETS), np.ones(I.BUCKETS), {}
    for d in docs:
        own[d["doc_id"]] = np.bincount(I.grams([(d["text"] or "").lower().encode()])[1], minlength=I.BUCKETS)
        raw += own[d["doc_id"]]
        target += own[d["doc_id"]] * (d["doc_id"] in good)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    got = op4_importance(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert np.isclose(r["log_weight"], own[r["doc_id"]] @ ratio) and r["n_grams"] == own[r["doc_id"]].sum()
    k = round(I.KEEP_SHARE * len(docs))
    top = sorted(got, key=lambda r: -r["gumbel_key"])[:k]
    assert {r["doc_id"] for r in got if r["selected"]} == {r["doc_id"] for r in top}


def test_edges(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    got = check_edges(spark, lambda d: I.resample(d, labels))
    assert all(r["log_weight"] == 0 and r["n_grams"] == 0 for r in got.where("doc_id IN (1, 2, 3)").collect())
    none = I.resample(awkward(spark), labels.where("quality = 7"), keep_share=1.0)
    assert none.where("selected").count() == awkward(spark).count()


def test_larger_weights_are_drawn_more_often(spark):
    """Gumbel top-k: with two weights in ratio e, the heavier rows win about e / (1 + e) of single draws."""
    u = (np.random.default_rng(0).integers(0, 1 << 53, (20000, 2)) + 0.5) / (1 << 53)
    key = np.array([1.0, 0.0]) - np.log(-np.log(u))
    assert abs((key[:, 0] > key[:, 1]).mean() - np.e / (1 + np.e)) < 0.02
