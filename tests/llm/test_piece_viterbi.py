import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from homeledger.llm import piece_viterbi as V
from homeledger.llm.queries import op9_piece_viterbi, piece_model
from tests.llm.helpers import SF, awkward, clashing


@pytest.fixture(scope="module")
def coder():
    return V.PieceCoder(piece_model())


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    own = {sp.id_to_piece(i): (sp.get_score(i), i) for i in range(sp.get_piece_size())
           if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    return own, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def brute(text, pieces):
    """Plain Viterbi over the whole marked text, no sharing and no cutting into words."""
    own, byte_ids = pieces
    if not text:
        return []
    s = "▁" + text.replace(" ", "▁")
    low = min(x for x, _ in own.values()) - V.UNKNOWN_PENALTY
    best, back = [0.0] + [None] * len(s), [None] * (len(s) + 1)
    for j in range(1, len(s) + 1):
        for i in range(max(0, j - 16), j):
            end = own.get(s[i:j]) or ((low, -1) if j - i == 1 else None)
            if end and (best[j] is None or best[i] + end[0] > best[j]):
                best[j], back[j] = best[i] + end[0], (i, end[1])
    ids, at = [], len(s)
    while at:
        i, piece = back[at]
        ids = ([piece] if piece >= 0 else [byte_ids[b] for b in s[i:at].encode()]) + ids
        at = i
    return ids


def ids_of(coder, text):
    return np.frombuffer(coder.encode([text])[0], "<u2").tolist()


TEXTS = ["Hello  world\n\tfoo  ", "", " ", "  a", "日本語 テキスト 😀 é́", "a" * 40, "x\n\n y", "Edating Erthen ariear", "tail   "]


def test_against_plain_viterbi(coder, pieces, spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(40).collect()
    for text in [*TEXTS, *(r["text"][:1500] for r in rows)]:
        assert ids_of(coder, text) == brute(text, pieces)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abthe \n▁é", max_size=25), max_size=5))
def test_any_batch(coder, pieces, texts):
    for text, got in zip(texts, coder.encode(texts)):
        ids = np.frombuffer(got, "<u2").tolist()
        assert ids == brute(text, pieces)
        assert coder.decode(ids) == text.replace("▁", " ")


def test_round_trip_of_the_whole_table(spark):
    got = op9_piece_viterbi(spark, SF)
    assert got.where("round_trip AND n_ids > 0").count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_edges(spark):
    docs = clashing(awkward(spark))
    coded = V.encode(docs, piece_model())
    assert coded.columns == [*docs.columns, "ids_2"]  # ids and ids_1 are taken
    back = V.decode(coded, piece_model(), ids="ids_2").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back) and len(back) == docs.count()
    assert V.encode(docs.where("doc_id = -1"), piece_model()).count() == 0
    trip = V.round_trip(docs, piece_model()).collect()
    assert all(r["round_trip"] for r in trip)


@pytest.fixture(scope="module")
def own():
    import sentencepiece
    return V.MergeCoder(piece_model()), sentencepiece.SentencePieceProcessor(model_file=piece_model())


def test_ids_are_those_of_sentencepiece(spark):
    """Whole documents through the operator."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    rows = V.encode(spark.read.parquet(f"{SF}/documents.parquet"), piece_model()).collect()
    assert len(rows) >= 200
    for r in rows:
        assert r["ids"] == sp.encode(r["text"])


def test_merges_of_awkward_texts(own):
    coder, sp = own
    long = "understandinginternationalcommunication" * 20
    for text in [*TEXTS, long, "a" * 5000, " " * 300, " " * 65 + "x", "ab" * 33 + "日本é\x00" * 30, "<s> </s> <unk> <0x0A>", "a▁▁b",
                 "understanding international communication requirements"]:
        assert ids_of(coder, text) == sp.encode(text), text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abtheringso \n▁é", max_size=90), max_size=5))
def test_merges_of_any_batch(own, texts):
    coder, sp = own
    for text, got in zip(texts, coder.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == sp.encode(text)


def test_words_remembered_over_generations(own, monkeypatch, spark):
    """Small caches: words and neighbours are dropped, moved back and worked out again."""
    monkeypatch.setattr(V, "CACHE_WORDS", 50)
    monkeypatch.setattr(V, "NEIGHBOURS", 30)
    coder, sp = V.MergeCoder(piece_model()), own[1]
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(60).collect()]
    for lo in range(0, 60, 7):
        for text, got in zip(texts[lo:lo + 7], coder.encode(texts[lo:lo + 7])):
            assert np.frombuffer(got, "<u2").tolist() == sp.encode(text)
    assert len(coder.neighbours) <= 30


def test_many_odd_words(own):
    """20,000 strings of pieces, characters without a piece and marks."""
    coder, sp = own
    rng = np.random.default_rng(6)
    some = [sp.id_to_piece(int(i)).replace(V.MARK, " ") for i in rng.integers(300, sp.get_piece_size(), 4000)]
    odd = ["é", "日", "\x00", "😀", " ", "\n", "\t", "'", "ß", "<", "1"]
    texts = ["".join(rng.choice(some if rng.random() < 0.8 else odd) for _ in range(rng.integers(1, 9))) for _ in range(20_000)]
    for text, got in zip(texts, coder.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == sp.encode(text), text
