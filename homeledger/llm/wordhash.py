"""Vectorised word hashes of a batch of texts."""

from __future__ import annotations


BASE = 0x100000001B3  # odd, so it has an inverse modulo 2**64


def _powers(base: int, n: int):
    import numpy as np

    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


def word_hashes(texts: list[bytes]):
    """(text number, hash) of every word, in order; words are cut at ASCII white space.

    A word's hash is a polynomial of its bytes modulo 2**64, mixed at the end:
    prefix sums give all of them at once.
    """
    import numpy as np

    buf = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    white = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    term = (buf.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(buf))
    total = np.concatenate([[np.uint64(0)], np.cumsum(term, dtype=np.uint64)])
    # the sum over the word, divided by the power of its first byte: its place does not matter
    h = (total[end] - total[start]) * _powers(pow(BASE, -1, 1 << 64), len(buf))[start]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    first = np.cumsum([1, *(len(t) + 1 for t in texts)])[:-1]
    return np.searchsorted(first, start, side="right") - 1, h


def pair_hashes(owner, h):
    """Hash of each pair of neighbouring words of one text: (text number, hash)."""
    import numpy as np

    same = owner[1:] == owner[:-1]
    two = h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:]
    two ^= two >> np.uint64(32)
    two *= np.uint64(0x9E3779B97F4A7C15)
    two ^= two >> np.uint64(29)
    return owner[:-1][same], two[same]


def batches_of(texts: list[str | None], size: int = 2_000_000):
    """(first row, UTF-8 texts) in runs of about ``size`` bytes, one row at least."""
    lo, run, n = 0, [], 0
    for i, t in enumerate(texts):
        b = (t or "").lower().encode()
        if run and n + len(b) > size:
            yield lo, run
            lo, run, n = i, [], 0
        run.append(b)
        n += len(b)
    if run:
        yield lo, run
