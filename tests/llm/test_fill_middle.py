import hashlib
import random
import re

import pytest

from homeledger.llm import fill_middle as M
from tests.conftest import SF_SMALL
from tests.llm.helpers import awkward, check_edges


def brute(doc_id, text, seed=7, rate=100, spm=50):
    """The definition, over code points and plain strings."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def run_text(doc_id, text, cache):
    import numpy as np

    data = text.encode()
    ends = M.chunk_ends(np.frombuffer(data, np.uint8)).tolist()
    assert (ends[-1] if ends else 0) == len(data) and max(np.diff([0, *ends]), default=0) <= M.MOST_BYTES
    n, form, pre, mid, out = M.transform_text(doc_id, data, ends, cache, 7, 100, 50)
    return n, form, pre, mid, out.decode()


def test_texts_against_definition():
    rng, cache = random.Random(3), M.Chunks()
    alphabet = ["a", "b ", "\n", "\n\n", "é", "日", "😀", "<", ">", "P", "<P", "S>", "\r", "\x00", "lorem ipsum "]
    texts = ["", "\n", "\n\n", "x", "x\n", "\nx", "<P>", "a<S>b", "<" * 5, "<M", "no end", "line\n" * 40_000, "y" * 50_000]
    texts += ["".join(rng.choices(alphabet, k=rng.choice((3, 40, 3000)))) for _ in range(300)]
    for k, t in enumerate(texts):
        assert run_text(k, t, cache) == brute(k, t), repr(t[:60])


def test_marks_across_chunk_boundaries(monkeypatch):
    monkeypatch.setattr(M, "MOST_BYTES", 2)
    cache = M.Chunks()
    for pad in range(7):
        for mark in ("<P>", "<S>", "<M>"):
            text = "z" * pad + mark + "q\nq"
            assert run_text(pad, text, cache) == brute(pad, text)
            assert run_text(pad, text.replace("<", "("), cache) == brute(pad, text.replace("<", "("))


def test_cache_entry_of_another_content_is_not_used(monkeypatch):
    import xxhash

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda chunk: 1)  # every chunk under one key
    cache = M.Chunks()
    for k, t in enumerate(["a\nb\nc", "no line", "é\n\n", "a\nb\nc"] * 3):
        assert run_text(k, t, cache) == brute(k, t)


def test_full_cache_gives_the_same(monkeypatch):
    monkeypatch.setattr(M, "CACHE_CHUNKS", 3)
    cache = M.Chunks()
    for k in range(50):
        t = f"line {k % 7}\n" * (k % 5 + 200)
        assert run_text(k, t, cache) == brute(k, t)
        assert len(cache) + len(cache.old) <= 6


def test_edges(spark):
    got = check_edges(spark, M.transform, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]).collect()
    want = [(r["doc_id"], *brute(r["doc_id"], r["text"])) for r in awkward(spark).collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


@pytest.mark.parametrize("rate, spm", [(0, 50), (60, 0), (100, 100)])
def test_rates(spark, rate, spm):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = sorted((r["doc_id"], *brute(r["doc_id"], r["text"], 3, rate, spm)) for r in docs.collect())
    assert sorted(map(tuple, M.transform(docs, 3, rate, spm).collect())) == want


def test_digests_and_round_trip(spark):
    docs = awkward(spark).unionByName(spark.createDataFrame(
        [(20, "a<P>b", None, None, None), (21, "x\n<S\ny>\n<\n", None, None, None), (22, "\n\n\n", None, None, None)],
        awkward(spark).schema))
    for r, d in zip(M.digests(docs).collect(), docs.collect()):
        assert r["restored_sha256"] == sha(d["text"] or "")
        assert r["output_sha256"] == sha(brute(d["doc_id"], d["text"])[4])


def test_query_matches_sql(spark):
    import __spark_entry__ as E
    from homeledger.plans.oracle_check import compare, duck_connection

    key = "op11_fill_middle"
    why = compare(E.queries()[key](spark, SF_SMALL).toPandas(),
                  duck_connection(SF_SMALL).execute(E.oracle_sql()[key]).df())
    assert why is None, why
