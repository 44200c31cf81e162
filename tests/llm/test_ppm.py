import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from homeledger.llm import ppm
from homeledger.llm.queries import op3_ppm_language
from tests.llm.helpers import SF, awkward, check_edges, clashing, rows_of


class Brute:
    """Context trees with dictionaries, one byte at a time."""

    def __init__(self, texts):
        self.n = defaultdict(Counter)
        for t in texts:
            b = b"\0" * ppm.ORDER + t.lower().encode()
            for i in range(ppm.ORDER, len(b)):
                for k in range(ppm.ORDER + 1):
                    self.n[b[i - k:i]][b[i]] += 1

    def bits(self, text):
        b, total = b"\0" * ppm.ORDER + text.lower().encode(), 0.0
        for i in range(ppm.ORDER, len(b)):
            for k in range(ppm.ORDER, -1, -1):
                c = self.n.get(b[i - k:i])
                if c is None:
                    continue
                whole = sum(c.values()) + len(c)
                if c[b[i]]:
                    total += math.log2(whole / c[b[i]])
                    break
                total += math.log2(whole / len(c))
            else:
                total += 8
        return total


def trees(by_lang):
    counts = []
    for texts in by_lang.values():
        codes, _ = ppm._grams([t.lower().encode() for t in texts])
        counts.append([np.unique(codes & np.uint32((1 << 8 * (k + 1)) - 1), return_counts=True) for k in range(ppm.ORDER + 1)])
    n = np.array([len(t) for t in by_lang.values()], float)
    return ppm.ContextTrees(list(by_lang), -np.log2(n / n.sum()), counts)


def test_code_lengths_are_exact():
    by_lang = {"de": ["der hund und die katze", "die straße"], "en": ["the dog and the cat", "a house on the street"]}
    model = trees(by_lang)
    texts = ["the cat", "die katze", "ß", "zzz qqq", "\0\0 the", "THE Street"]
    got = model.code_lengths([t.lower().encode() for t in texts])
    for j, lang in enumerate(by_lang):
        brute = Brute(by_lang[lang])
        assert np.allclose(got[:, j], [brute.bits(t) for t in texts])
    lang, score, bpb = model.predict(["the dog", "die hunde", None, "", "123 ..."])
    assert lang == ["en", "de", "und", "und", "und"] and score[2:] == [0.0] * 3 and all(0 <= s <= 1 for s in score)


def test_runs_of_long_texts_add_up(monkeypatch):
    model = trees({"de": ["der hund und die katze"], "en": ["the dog and the cat"]})
    texts = [b"the cat and the dog " * 9, b"x", "die straße 日本".encode() * 5]
    whole = model.code_lengths(texts)
    for size in (4, 5, 17, 100):
        monkeypatch.setattr(ppm, "RUN_BYTES", size)
        assert np.allclose(model.code_lengths(texts), whole)


def test_memory_on_one_long_text():
    import tracemalloc

    model = trees({"de": ["der hund und die katze"], "en": ["the dog and the cat"]})
    text = "thecatandthedogs" * 625_000
    tracemalloc.start()
    assert model.predict([text])[0] == ["en"]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6


def test_held_out_accuracy(spark):
    got = op3_ppm_language(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.97


def test_held_out_rows_teach_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(ppm.learnable(), F.col("lang")).otherwise(F.lit("xx")))
    assert rows_of(ppm.identify(wrong)) == rows_of(ppm.identify(docs))


def test_edges(spark):
    got = {(r["doc_id"], r["lang_pred"]) for r in check_edges(spark, ppm.identify).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (11, "und"), (None, "und")} <= got
    nothing = awkward(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in ppm.identify(nothing).collect()} == {"und"}
    kept = ppm.keep_identified(clashing(awkward(spark)))
    assert kept.columns == clashing(awkward(spark)).columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({1, 2, 3, 11})
    assert ppm.keep_identified(nothing.where("doc_id = -1")).count() == 0
