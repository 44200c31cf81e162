import math
from collections import Counter, defaultdict

import numpy as np

from homeledger.llm import cross_entropy as X
from homeledger.llm.queries import op8_cross_entropy
from tests.llm.helpers import SF, awkward, check_edges


def brute(docs, good, size):
    texts = {i: [w for w in t.lower().encode().split()] for i, t in docs}
    count = Counter(w for t in texts.values() for w in t)
    vocab = {w: k + 1 for k, w in enumerate(sorted(count, key=lambda w: (-count[w], w))[:size - 1])}
    ids = {i: [vocab.get(w, 0) for w in t] for i, t in texts.items()}

    def model(keep):
        pair, uni, follow = Counter(), Counter(), defaultdict(set)
        for i in keep:
            for a, b in zip([size, *ids[i][:-1]], ids[i]):
                pair[a, b] += 1
                uni[b] += 1
                follow[a].add(b)
        seen = Counter()
        for (a, _), n in pair.items():
            seen[a] += n
        total = sum(uni.values())

        def loss(a, b):
            u = (uni[b] + 1) / (total + size)
            p = u if not seen[a] else (max(pair[a, b] - 0.75, 0) + 0.75 * len(follow[a]) * u) / seen[a]
            return -math.log2(p)
        return loss
    target, background = model([i for i in ids if i in good]), model(list(ids))
    out = {}
    for i, own in ids.items():
        pairs = list(zip([size, *own[:-1]], own))
        out[i] = (len(own), *((np.mean([m(*p) for p in pairs]) if pairs else None) for m in (target, background)))
    return out


def test_whole_table_small_vocabulary(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    for size in (50, 2048):
        want = brute(docs, good, size)
        for r in X.cross_entropy_difference(df, labels, size).collect():
            n, t, b = want[r["doc_id"]]
            assert r["n_words"] == n and np.allclose([r["target_loss"], r["background_loss"], r["score"]], [t, b, t - b])


def test_good_texts_score_lower(spark):
    sf = "/root/testdata/sf0.01"
    r = (op8_cross_entropy(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
         .groupBy("quality").avg("score").collect())
    mean = {x["quality"]: x["avg(score)"] for x in r}
    assert mean[1] < mean[0] - 1


def test_edges(spark):
    labels = spark.createDataFrame([(4, 1), (None, 1), (6, None)], "doc_id long, quality int")
    got = check_edges(spark, lambda d: X.cross_entropy_difference(d, labels, 40))
    assert all(r["n_words"] == 0 and r["score"] is None for r in got.where("doc_id IN (1, 2, 3)").collect())
    assert X.cross_entropy_difference(awkward(spark), labels.where("quality = 9"), 40).count() == awkward(spark).count()


def test_all_words_are_told_apart(spark, monkeypatch):
    """More distinct words than any table of frequent words, several blocks and buckets."""
    import duckdb

    monkeypatch.setattr(X, "BLOCK_CHARS", 20_000)
    monkeypatch.setattr(X, "BUCKET_BYTES", 30_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(150).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").toPandas()
    words = {w for t in docs["text"] for w in t.lower().encode().split()}
    assert len(words) > 2048
    good = set(labels["doc_id"][labels["quality"] == 1])
    want = brute(list(zip(docs["doc_id"], docs["text"])), good, len(words) + 1)
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("labels", labels)
    twin = {r[0]: r[1:] for r in con.execute(X.duck_sql()).fetchall()}
    got = X.cross_entropy_difference(spark.createDataFrame(docs), spark.createDataFrame(labels)).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["n_words"] == want[r["doc_id"]][0]
        assert np.allclose([r["target_loss"], r["background_loss"]], want[r["doc_id"]][1:])
        assert np.allclose(list(r)[1:], twin[r["doc_id"]])


def test_rare_words_change_the_score(spark):
    """Two documents that differ in rare words only, one sharing them with the target."""
    common = [f"c{k}" for k in range(3000)]
    rows = [(k, f"{' '.join(common)} end") for k in range(3)] + [(10, "c1 rarea c2"), (11, "c1 rareb c2"), (12, "c1 rarea c2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(12, 1)], "doc_id long, quality int")
    score = {r["doc_id"]: r["score"] for r in X.cross_entropy_difference(docs, labels).collect()}
    assert score[10] == score[12] < score[11] - 0.5


def test_registered_sql_agrees_on_the_whole_table(spark):
    import __spark_entry__ as E
    from homeledger.plans.oracle_check import compare, duck_connection
    from tests.llm.helpers import SF

    why = compare(E.queries()["op8_cross_entropy"](spark, SF).toPandas(),
                  duck_connection(SF).execute(E.oracle_sql()["op8_cross_entropy"]).df())
    assert why is None, why
