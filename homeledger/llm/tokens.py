"""Token ids of whole texts with a public word-BPE tokenizer file, one cached word at a time."""

from __future__ import annotations

import re
from array import array
from os.path import commonprefix

from homeledger.llm.shared import worker_state

#: Words and pre-tokens that one generation of a Python worker's cache holds.
CACHE_WORDS = 300_000
CACHE_PARTS = 600_000
# Letters whose lower case and composed form are plain one-to-one steps.
_LATIN = "À-ÖØ-öø-ÿĀ-įı-ſ"
_PLAIN = re.compile(f"[!-~{_LATIN}]+").fullmatch
# The tokenizer's own pre-token pattern, for lower-case words of those letters.
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^\\sa-z0-9{_LATIN}]+").findall


def byte_letters() -> dict[int, str]:
    """Character -> the printable stand-ins of its UTF-8 bytes (byte-level BPE): printable bytes
    stand for themselves, the others for U+0100 onwards in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand = {b: chr(b) for b in keep}
    stand |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in stand)}
    return {c: "".join(stand[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}


class Generations(dict):
    """A cache of two generations: a full one becomes the old one, and what is asked for again
    moves back, so frequent keys stay and memory is bounded by twice ``most``."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def __missing__(self, key):
        out = self.old.get(key)
        if out is None:
            out = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = out
        return out


class PartIds(Generations):
    """Lower-case pre-token -> its ids: words that differ in case or punctuation share them."""

    def __init__(self, bpe, code: str):
        super().__init__(CACHE_PARTS)
        self.bpe, self.code, self.letters = bpe, code, byte_letters()

    def make(self, part: str) -> bytes:
        plain = part if part.isascii() else part.translate(self.letters)
        return array(self.code, [t.id for t in self.bpe(plain)]).tobytes()


class WordIds(Generations):
    """Word (UTF-8, no ASCII white space) -> its ids as little-endian bytes.

    Ids take 2 bytes when the vocabulary has at most 65,536 of them, else 4.
    Cutting a text at ASCII white space never changes its ids: every
    normalisation and pre-token pattern of the tokenizer stops there.  Words of
    printable ASCII and plain Latin letters go to the BPE model at once; others,
    and words that hold one of the tokenizer's special tokens, take its whole path.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__(CACHE_WORDS)
        self.tok = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.opening = commonprefix(self.specials)
        self.code = "H" if self.tok.get_vocab_size() <= 65_536 else "I"
        self.parts = PartIds(self.tok.model.tokenize, self.code)
        self.size = array(self.code).itemsize
        self.dtype = f"<u{self.size}"

    def make(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only
            return self.parts[word.lower().decode()]
        text = word.decode()
        if _PLAIN(text) and not (self.opening in text and any(t in text for t in self.specials)):
            return b"".join(map(self.parts.__getitem__, _PARTS(text.lower())))
        return array(self.code, self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def text_ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))


def word_ids(path: str) -> WordIds:
    """The worker's tokenizer for ``path``."""
    held = worker_state("word_ids", dict)
    if path not in held:
        held[path] = WordIds(path)
    return held[path]
