import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from homeledger.llm import packing
from homeledger.llm.queries import op2_packing, word_tokenizer
from tests.llm.helpers import SF, awkward, check_edges


def reference_ids(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(word_tokenizer())
    return [tok.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def check_pieces(pieces, ids_of):
    """Every id in one piece, offsets gapless, checksums right, sequences full but one per group."""
    seqs = defaultdict(list)
    for p in pieces:
        seqs[p["sequence_id"]].append(p)
    for own in seqs.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and own[0]["tier"] in (0, at)
    docs = defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
    for doc, own in docs.items():
        ids = np.array(ids_of[doc], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    return seqs


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    ids = dict(zip([d["doc_id"] for d in docs], reference_ids([d["text"] for d in docs])))
    pieces = op2_packing(spark, SF).collect()
    assert {p["doc_id"] for p in pieces} == set(ids)
    seqs = check_pieces(pieces, ids)
    sizes = [sum(p["length"] for p in own) for own in seqs.values()]
    padded = sum(n if n & (n - 1) == 0 else 2048 for n in sizes)
    assert sum(sizes) / padded > 0.98


def test_edges_and_many_groups(spark):
    check_edges(spark, lambda d: packing.pack(d, word_tokenizer()))
    once = awkward(spark).where("doc_id IS NOT NULL AND doc_id <> 6")
    docs = once.collect()
    ids = dict(zip([d["doc_id"] for d in docs], reference_ids([d["text"] for d in docs])))
    pieces = packing.pack(once, word_tokenizer(), group_bytes=50_000, with_ids=True).collect()
    check_pieces(pieces, ids)
    for p in pieces:
        assert np.frombuffer(p["ids"], "<u2").tolist() == ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=60))
def test_pack_lengths(lengths):
    seqs = packing.pack_lengths(lengths)
    short = [t for t, _ in seqs if t == 0]
    assert len(short) <= 1
    for tier, pieces in seqs:
        n = sum(k for _, _, k in pieces)
        assert n == tier or tier == 0 and n < 2048
    parts = defaultdict(list)
    for _, pieces in seqs:
        for item, start, n in pieces:
            parts[item].append((start, n))
    for item, n in enumerate(lengths):
        at = 0
        for start, k in sorted(parts[item]):
            assert start == at
            at += k
        assert at == n


@pytest.mark.parametrize("n", [1, 33, 1000])
def test_steps_are_balanced(n):
    rng = np.random.default_rng(n)
    seqs = [(int(t), int(t) * 100) for t in rng.choice([256, 512, 1024, 2048], n)]
    step = packing.step_groups(seqs, 2048, 8)
    tokens = np.bincount(step, [t for t, _ in seqs])
    assert tokens.max() <= 2048 * 9 and len(tokens) <= n // 8 + 1


def test_word_ids_follow_the_tokenizer():
    from homeledger.llm.tokens import WordIds
    w = WordIds(word_tokenizer())
    words = [a + chr(c) + b for c in range(33, 0x180) for a in ("", "x", "É", "'") for b in ("", "s", "3", "'ll")]
    for text in [*words, "a b\x1cc", "İ ΑΣ ﬁ 한국어", "x́ <|endoftext|> don't I'LL", "<|startoftext|>a<|endoftext|>b<|endoftext|", "<|ENDOFTEXT|> <| |>"]:
        assert np.frombuffer(w.text_ids(text), w.dtype).tolist() == w.tok.encode(text, add_special_tokens=False).ids


def test_special_tokens_in_texts(spark):
    """Texts that hold the tokenizer's special tokens give its own ids for them."""
    texts = ["hello <|endoftext|> world", "<|startoftext|>", "a<|endoftext|><|startoftext|>B", "no <|end oftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = reference_ids(texts)
    assert 49407 in want[0]
    check_pieces(packing.pack(docs, word_tokenizer()).collect(), dict(enumerate(want)))


def test_rows_without_text_spread_over_groups(spark):
    """Every row gives an end id, so rows count towards the number of groups."""
    docs = spark.range(4000).selectExpr("id AS doc_id", "if(id % 2 = 0, '', null) AS text")
    pieces = packing.pack(docs, word_tokenizer(), group_bytes=4000).collect()
    rows = defaultdict(int)
    for r in pieces:
        rows[r["sequence_id"] >> 32] += 1
    assert sum(rows.values()) == 4000 and len(rows) > 16 and max(rows.values()) < 1000
