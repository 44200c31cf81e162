import numpy as np
from pyspark.sql import functions as F

from homeledger.llm import separator_scan as S
from homeledger.llm.queries import op1_separator_scan, word_tokenizer
from tests.llm.helpers import SF, awkward, check_edges
from tests.llm.test_packing import reference_ids


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {d["doc_id"]: len(i) - 1 for d, i in zip(docs, reference_ids([d["text"] for d in docs]))}
    got = op1_separator_scan(spark, SF).collect()
    assert len(got) == len(want) and {r["doc_id"]: r["n_tokens"] for r in got} == want


def test_edges_and_tiny_blocks(spark):
    run = lambda d: S.token_counts(d, word_tokenizer(), 49408, file_tokens=777, block_tokens=50)
    got = check_edges(spark, lambda d: run(d).drop("start"), ["doc_id", "n_tokens"])
    docs = awkward(spark).collect()
    want = sorted((str(d["doc_id"]), len(i) - 1) for d, i in zip(docs, reference_ids([d["text"] for d in docs])))
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got.collect()) == want


def test_special_tokens_end_no_document(spark):
    texts = ["a <|endoftext|> b", "<|endoftext|><|startoftext|>", "c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in S.token_counts(docs, word_tokenizer(), 49408).collect()}
    assert got == {k: len(i) - 1 for k, i in enumerate(reference_ids(texts))}


def test_stitch_against_brute_force(spark):
    """Blocks without an end, several groups of files, and an unfinished last document."""
    rng = np.random.default_rng(3)
    rows, want = [], []
    for stream in ("a", "b"):
        ids = np.where(rng.random(6000) < 0.01, 9, 1)
        ids[-5:] = 1
        ends = np.flatnonzero(ids == 9)
        starts = np.concatenate([[0], ends + 1])
        want += [(stream, k, int(s), int(e - s), True) for k, (s, e) in enumerate(zip(starts, ends))]
        want.append((stream, len(ends), int(starts[-1]), 6000 - int(starts[-1]), False))
        for f in range(600):  # files of ten ids, two blocks each
            for part in range(2):
                own = ids[f * 10 + part * 5:f * 10 + part * 5 + 5]
                rows.append((stream, (f, part), 5, np.flatnonzero(own == 9).tolist()))
    blocks = spark.createDataFrame(rows, "stream string, block struct<file:long, part:long>, n_tokens long, ends array<long>")
    got = S.stitch(blocks.orderBy(F.rand(1))).collect()
    assert sorted(map(tuple, got)) == sorted(want)
