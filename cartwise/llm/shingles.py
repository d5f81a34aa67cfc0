"""Word shingles of texts as 64-bit hashes, many texts at a time in numpy.

Words are runs of characters above U+0020 of the lower-cased text. A shingle is five consecutive words;
a text with fewer words has one shingle of all of them, a text without words has none.
"""

from __future__ import annotations

import numpy as np

from cartwise.llm.common import mix64

WORDS = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_PLACES = np.array([0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS[0]) < n:
        for i, b in enumerate((_BASE, _INVERSE)):
            x = np.full(n, b, dtype=np.uint64)
            x[0] = 1
            _POWERS[i] = np.cumprod(x, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and how many words each text has."""
    raw = [(t or "").lower().encode("utf-8", "replace") + b"\n" for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    b = np.frombuffer(b"\n" + b"".join(raw), dtype=np.uint8)
    gap = b <= 32
    start = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    stop = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    power, inverse = _powers(len(b) + 1)
    total = np.empty(len(b) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
    h = mix64((total[stop] - total[start]) * inverse[start] + (stop - start).astype(np.uint64))
    ends = np.cumsum(sizes) + 1
    return h, np.diff(np.searchsorted(start, np.r_[0, ends]))


def shingles(texts: list, words: int = WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct shingle hashes (sorted) and how often each occurs."""
    h, counts = word_hashes(texts)
    places = _PLACES[:words]
    n = len(h) - words + 1
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(words):
        rolled += h[j : j + max(n, 0)] * places[j]
    rolled = mix64(rolled)
    out, at = [], 0
    for c in counts.tolist():
        if c >= words:
            out.append(np.unique(rolled[at : at + c - words + 1], return_counts=True))
        elif c:
            one = np.zeros(1, dtype=np.uint64)
            for j in range(c):
                one += h[at + j : at + j + 1] * places[j]
            out.append((mix64(one + np.uint64(c)), np.ones(1, dtype=np.int64)))
        else:
            out.append((np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)))
        at += c
    return out
