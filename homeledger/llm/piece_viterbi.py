"""SentencePiece encoding and decoding by a shared-prefix walk (operator 9).

The public model is a BPE model: its scores are minus the merge ranks, and a
text's encoding joins, again and again, the neighbours whose piece has the
highest score.  ``MergeCoder`` gives these ids, SentencePiece's own, from a
forward table over the trie of sorted words; the queries use it.  ``PieceCoder``
alone takes the segmentation with the highest sum of scores (the unigram rule),
which is another encoding under such a model, from a table of the same shape.

No piece holds the space mark after another character, so a text falls apart
into marked words (a run of marks and what follows), and each distinct word has
one answer.  Words are remembered per Python worker.  A batch's new words are
sorted, which lines them up as a depth-first walk of their trie: the forward
table, back pointers and open pieces of the prefix shared with the word before
are kept, and only the rest is searched.

Characters without a piece become the byte pieces of their UTF-8 form.
"""

from __future__ import annotations

import re
from array import array
from os.path import commonprefix

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homeledger.llm.shared import fresh_name, worker_state
from homeledger.llm.tokens import Generations

MARK = "▁"
CACHE_WORDS = 200_000
UNKNOWN_PENALTY = 10.0
NO_PIECE = float("inf")
#: Pairs of pieces that one generation of the cache of neighbours holds.
NEIGHBOURS = 200_000
#: Steps between states that a worker remembers.
STEPS = 100_000
START = 1 << 18  # above all ids: the start of a word; higher numbers are characters without a piece


class PieceCoder:
    """Encoder and decoder over the pieces and scores of a model file with byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.trie: dict = {}
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.code = "H" if sp.get_piece_size() <= 65_536 else "I"
        self.out: list[bytes] = []
        lowest, texts = 0.0, []
        self.byte_ids = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.out.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.out.append(b"")
            else:
                node = self.trie
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = (sp.get_score(i), i)
                self.rank[piece], self.ids[piece] = -sp.get_score(i), i
                lowest = min(lowest, sp.get_score(i))
                texts.append(piece)
                self.out.append(piece.replace(MARK, " ").encode())
        self.unknown = lowest - UNKNOWN_PENALTY
        if any(MARK in p.lstrip(MARK) for p in texts):
            raise ValueError("a piece holds the space mark after another character")
        # a line end without a piece of its own separates words as well
        cut = "" if any("\n" in p for p in texts) else "\n"
        self.words = re.compile(f"{MARK}+[^{MARK}{cut}]*|[^{MARK}{cut}]+" + (f"|{cut}" if cut else "")).findall
        self.cache: dict[str, bytes] = {}
        self.marked: dict[str, bytes] = {}  # words as they stand between spaces
        self.older: dict[str, bytes] = {}   # the generation of ``marked`` before

    def learn(self, words: list[str]) -> None:
        """Segment sorted distinct words, reusing what the previous word's prefix settled."""
        trie, unknown, cache = self.trie, self.unknown, self.cache
        best, back, open_at, last = [0.0], [(0, 0)], [[]], ""
        for word in words:
            keep = len(commonprefix((last, word)))
            del best[keep + 1:], back[keep + 1:], open_at[keep + 1:]
            for j in range(keep, len(word)):
                c, still, top, link = word[j], [], None, None
                for i, node in open_at[j]:
                    node = node.get(c)
                    if node is not None:
                        still.append((i, node))
                        end = node.get("")
                        if end is not None and (top is None or best[i] + end[0] > top):
                            top, link = best[i] + end[0], (i, end[1])
                node = trie.get(c)
                end = None
                if node is not None:
                    still.append((j, node))
                    end = node.get("")
                score, piece = end if end is not None else (unknown, -1)
                if top is None or best[j] + score > top:
                    top, link = best[j] + score, (j, piece)
                best.append(top)
                back.append(link)
                open_at.append(still)
            ids, at = [], len(word)
            while at:
                i, piece = back[at]
                if piece >= 0:
                    ids.append(piece)
                else:
                    ids += [self.byte_ids[b] for b in reversed(word[i:at].encode())]
                at = i
            ids.reverse()
            cache[word] = array(self.code, ids).tobytes()
            last = word

    def encode(self, texts: list[str]) -> list[bytes]:
        """ids of each text, as bytes of the array type ``code``; an empty text has none."""
        # single spaces (the usual case): every stretch between them is one marked word or a few
        simple = [t != "" and t[0] != " " and t[-1] != " " and "  " not in t and MARK not in t for t in texts]
        split = [t.split(" ") if s else self.words(MARK + t.replace(" ", MARK)) if t else []
                 for t, s in zip(texts, simple)]
        if len(self.marked) > CACHE_WORDS:
            self.older, self.marked = self.marked, {}
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        cache, marked, older = self.cache, self.marked, self.older
        plain = set().union(*(w for w, s in zip(split, simple) if s)) - marked.keys()
        for w in plain & older.keys():  # what is asked for again moves back
            marked[w] = older[w]
        plain -= older.keys()
        parts = {w: self.words(MARK + w) if "\n" in w else [MARK + w] for w in plain}
        new = set().union(*parts.values(), *(w for w, s in zip(split, simple) if not s)) - cache.keys()
        self.learn(sorted(new))
        for w, own in parts.items():
            marked[w] = cache[own[0]] if len(own) == 1 else b"".join(map(cache.__getitem__, own))
        return [b"".join(map(marked.__getitem__ if s else cache.__getitem__, words))
                for words, s in zip(split, simple)]

    def decode(self, ids) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")[1:]


class MergeCoder(PieceCoder):
    """Encoder in the merge order of a BPE model file: the ids of SentencePiece itself.

    Every prefix of a word has one encoding, hence one last piece: the piece
    that ends there and whose two texts, its own and that of the last piece
    before it, merge to just these two.  So a forward table over the sorted
    words' trie holds that piece for every prefix, as the Viterbi table holds
    the best score; whether two pieces can be neighbours is worked out by
    merging once and remembered.  The pieces that end at a prefix are those that
    end its longest ending found at the start of a piece, a state that the next
    character leads on from, so no list of open pieces is kept for each prefix.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.neighbours = Generations(NEIGHBOURS)
        self.neighbours.make = self.fit_together
        self.text = {i: p for p, i in self.ids.items()}
        self.trie.clear()  # the states take its place
        self.starts = {piece[:k] for piece in self.ids for k in range(1, len(piece) + 1)}
        self.states: dict[str, tuple[dict, tuple, str]] = {}
        self.known_steps = 0
        self.root = self.state("")

    def state(self, tail: str) -> tuple[dict, tuple, str]:
        """The state of all prefixes whose longest ending that begins a piece is ``tail``: known steps to
        other states, (length, id) of the pieces that end here, longest first, and ``tail``."""
        held = self.states.get(tail)
        if held is None:
            ends = ((len(tail) - k, self.ids.get(tail[k:], -1)) for k in range(len(tail)))
            held = self.states[tail] = ({}, tuple(e for e in ends if e[1] >= 0), tail)
        return held

    def step(self, state: tuple, c: str) -> tuple:
        """The state after one more character, remembered."""
        if self.known_steps >= STEPS:
            self.known_steps = 0
            for steps, _, _ in self.states.values():
                steps.clear()
        tail = state[2] + c
        k = 0
        while k < len(tail) and tail[k:] not in self.starts:
            k += 1
        self.known_steps += 1
        state[0][c] = out = self.state(tail[k:])
        return out

    def merge(self, text: str) -> list[str]:
        """The pieces (or single characters) that merging leaves of a short text."""
        rank, parts = self.rank.get, list(text)
        ranks = [rank(a + b, NO_PIECE) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < NO_PIECE:
            i = ranks.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], NO_PIECE)
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], NO_PIECE)
        return parts

    def fit_together(self, key: int) -> bool:
        """Whether the piece of the lower bits can follow that of the upper ones (or start a word)."""
        before, piece = key >> 20, self.text[key & 0xFFFFF]
        if before == START:
            return self.merge(piece) == [piece]
        first = chr(before - START - 1) if before > START else self.text[before]
        if first + piece in self.rank:  # merging would not stop at the two
            return False
        return self.merge(first + piece) == [first, piece]

    def learn(self, words: list[str]) -> None:
        """Encode sorted distinct words, reusing what the previous word's prefix settled."""
        step, fits, cache, code = self.step, self.neighbours, self.cache, self.code
        last, back, states, before = [START], [0], [self.root], ""
        for word in words:
            keep = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                keep += 1
            del last[keep + 1:], back[keep + 1:], states[keep + 1:]
            state = states[keep]
            for j in range(keep, len(word)):
                c = word[j]
                state = state[0].get(c) or step(state, c)
                for n, piece in state[1]:  # the longest piece first
                    if n == 1 or fits[last[j + 1 - n] << 20 | piece]:
                        link = j + 1 - n
                        break
                else:
                    link, piece = j, START + 1 + ord(c)
                last.append(piece)
                back.append(link)
                states.append(state)
            out, at = [], len(word)
            while at:
                piece = last[at]
                if piece < START:
                    out.append(piece)
                else:
                    out += [self.byte_ids[x] for x in reversed(word[at - 1].encode())]
                at = back[at]
            out.reverse()
            cache[word] = array(code, out).tobytes()
            before = word


def coder(path: str) -> MergeCoder:
    """The worker's coder for a model file."""
    held = worker_state("piece_coders", dict)
    if path not in held:
        held[path] = MergeCoder(path)
    return held[path]


def _with_column(df: DataFrame, name: str, kind: T.DataType, source: str, make) -> DataFrame:
    """``df`` plus a column ``name`` made from ``source`` batch by batch; ``name`` must be new."""
    at = df.columns.index(source)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, make(b.column(at))], names=[*b.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, kind)]))


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", run_chars: int = 2_000_000) -> DataFrame:
    """``docs`` with the ids of ``text`` in a new column (``ids``, renamed if taken).

    A null or empty text has no ids (an empty array).  Repeated rows and other
    columns are kept; an empty table stays empty; very long texts are encoded
    whole.
    """

    def make(column):
        import numpy as np
        import pyarrow as pa

        c = coder(model)
        texts = [t or "" for t in column.to_pylist()]
        out, lo, n = [], 0, 0
        for i, t in enumerate(texts):
            n += len(t)
            if n >= run_chars or i == len(texts) - 1:
                out += c.encode(texts[lo:i + 1])
                lo, n = i + 1, 0
        width = array(c.code).itemsize
        ends = np.cumsum([0, *(len(x) // width for x in out)])
        flat = np.frombuffer(b"".join(out), f"<u{width}").astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    return _with_column(docs, fresh_name(docs, ids), T.ArrayType(T.IntegerType()), text, make)


def decode(tokens: DataFrame, model: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``tokens`` with the text of ``ids`` in a new column (``text``, renamed if taken); null or no ids: empty text."""

    def make(column):
        import pyarrow as pa

        c = coder(model)
        values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        return pa.array([c.decode(values[a:b].tolist()) for a, b in zip(offsets[:-1], offsets[1:])], pa.string())

    return _with_column(tokens, fresh_name(tokens, text), T.StringType(), ids, make)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_ids, ids_hash, round_trip): every text encoded and decoded again.

    ``ids_hash`` is the 64-bit hash of the id array, ``round_trip`` whether the
    decoded text equals the original (the space mark itself decodes to a space).
    A null text counts as empty.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    done = decode(encode(rows, model), model)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"),
                       (F.col("decoded") == F.col("text")).alias("round_trip"))
