import hashlib
import random

import numpy as np
import pytest

from homeledger.llm import block_anchors as A
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, check_edges, clashing, rows_of

SCHEMA = "doc_id long, text string"


def brute(rows, window):
    """(doc_id, n_words, n_removed, spans, kept) by the definition: every window against all documents."""
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    low = {}
    for i, w in docs:
        if i is not None:
            for p in range(len(w) - window + 1):
                g = tuple(w[p:p + window])
                low[g] = min(low.get(g, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        if i is not None:
            for p in range(len(w) - window + 1):
                if low[tuple(w[p:p + window])] < i:
                    gone[p:p + window] = [True] * window
        spans, k = [], 0
        while k < len(w):
            if gone[k]:
                s = k
                while k < len(w) and gone[k]:
                    k += 1
                spans.append((s, k - s))
            k += 1
        out.append((i, len(w), sum(gone), spans, b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], [tuple(s) for s in r["spans"]], r["kept"])
                   for r in df.collect()), key=repr)


def planted(seed, n=60, window=8):
    """Random texts of few words with shared passages at every alignment, near copies, copies and self-repeats."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(400)}"
    passages = [[word() for _ in range(rng.choice((window - 1, window, window + 1, 3 * window)))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = [word() for _ in range(rng.randrange(0, 60))]
        for p in rng.sample(passages, rng.randrange(0, 4)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = p
        if i % 7 == 3:
            w = w + w
        if i % 6 == 5:  # a near copy: one word replaced, put in or taken out
            w = rows[rng.randrange(len(rows))][1].split()
            at = rng.randrange(len(w) + 1)
            w[at:at + rng.randrange(2)] = [word()] * rng.randrange(2)
        rows.append((i if i % 11 else i // 2, rng.choice((" ", "\n", "\t ")).join(w)))
    rows += [rows[4], (500, rows[8][1]), (501, rows[8][1]), (None, rows[8][1]), (502, " ".join(["same"] * 40)),
             (503, " ".join(["same"] * 25))]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("window, seed, small", [(8, 1, False), (8, 2, True), (7, 3, True), (1, 4, True), (50, 5, False)])
def test_against_brute_force(spark, monkeypatch, window, seed, small):
    if small:  # many chunks and buckets
        for name, v in (("CHUNK_BYTES", 300), ("BUCKET_WORDS", 200)):
            monkeypatch.setattr(A, name, v)
    rows = planted(seed, window=window)
    assert got(A.remove_repeats(spark.createDataFrame(rows, SCHEMA), window)) == brute(rows, window)


def test_passage_of_every_document(spark, monkeypatch):
    """One passage in every document at every alignment, with other words around it."""
    rng = random.Random(9)
    passage = [f"p{k}" for k in range(70)]
    rows = []
    for i in range(120):
        w = [f"d{i}-{k}" for k in range(rng.randrange(40))]
        rows.append((i, " ".join(w + passage[rng.randrange(12):] + [f"e{i}-{k}" for k in range(rng.randrange(40))])))
    want = brute(rows, 50)
    assert sum(r[2] for r in want) > 100 * 58
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(A.remove_repeats(df)) == want
    monkeypatch.setattr(A, "CHUNK_BYTES", 2000)
    assert got(A.remove_repeats(df)) == want


def test_packing_of_hashes():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 1000, 8191, 8192, 50_000):
        v = np.unique(rng.integers(0, 1 << 32, n, np.uint64).astype(np.uint32))
        assert (A.unpack(A.pack(v), len(v)) == v).all()
    ends = np.array([0, (1 << 32) - 1], np.uint32)
    assert (A.unpack(A.pack(ends), 2) == ends).all()


def test_rolling_hash_depends_on_words_only():
    words = [f"x{k % 5}" for k in range(60)]
    a = A.hash_words([" ".join(words).encode(), b"", "é ".encode() + " ".join(words[10:]).encode()])
    assert a[0].tolist() == [0, 60, 60, 111]
    for size in (1, 2, 3, 7, 25, 50, 60):
        h = A.rolling(a[1], size)
        assert len(h) == 111 - size + 1
        if size <= 50:
            assert h[10] == h[61]


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(f"w{k}" for k in range(5000)).encode()
    whole = A.hash_words([b"a b", text, b"", b"c"])
    monkeypatch.setattr(A, "_RUN", 100)
    parts = A.hash_words([b"a b", text, b"", b"c"])
    assert all((x == y).all() for x, y in zip(whole, parts))


def test_edges(spark):
    op = lambda d: A.remove_repeats(d, 4)
    check_edges(spark, op, ["doc_id", "n_words", "n_removed", "spans", "kept"])
    docs = awkward(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(op(docs)) == brute(rows, 4)
    one = docs.where("doc_id = 5")
    assert got(op(one)) == brute([(5, "Two words")], 4)
    assert rows_of(A.digests(clashing(docs))) == rows_of(A.digests(docs))
    with pytest.raises(ValueError):
        A.remove_repeats(docs, 0)


def test_digest_is_of_the_kept_words(spark):
    rows = [(1, " ".join(f"a{k}" for k in range(60))), (2, "x y " + " ".join(f"a{k}" for k in range(5, 60)) + "  z")]
    for r in A.digests(spark.createDataFrame(rows, SCHEMA)).collect():
        want = next(b for b in brute(rows, 50) if b[0] == r["doc_id"])
        assert (r["n_removed"], r["kept_sha256"]) == (want[2], hashlib.sha256(want[4].encode()).hexdigest())


def test_query_matches_sql(spark):
    import __spark_entry__ as E
    from homeledger.plans.oracle_check import compare, duck_connection

    key = "op12_block_anchors"
    why = compare(E.queries()[key](spark, SF_SMALL).toPandas(),
                  duck_connection(SF_SMALL).execute(E.oracle_sql()[key]).df())
    assert why is None, why
