"""Word shingles of a text as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
from xxhash import xxh64_intdigest

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8").lower().split() if text else []


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Distinct runs of ``words`` words; a shorter text is one run of all its words, a text without words has none."""
    found = ascii_words(text)
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxh64_intdigest, found), np.uint64, len(found))
    size = min(words, len(w))
    n = len(w) - size + 1
    x = np.full(n, size, np.uint64)
    for i in range(size):
        x = x * _STEP + w[i:i + n]
    return np.unique(mixed(x))
