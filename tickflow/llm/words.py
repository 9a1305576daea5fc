"""Whole texts as arrays of 64-bit word hashes."""

from __future__ import annotations

import numpy as np
import xxhash

from tickflow.llm.common import process_cache

CACHE_WORDS = 150_000
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    """word -> hash, remembered up to CACHE_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words of the text in order, A-Z taken as a-z."""
    words = text.encode().lower().split()
    table = process_cache("word hashes", WordHashes)
    return np.fromiter(map(table.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX_B
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, n: int = 2) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; a text of fewer words is
    one shingle; a text without words has none."""
    h = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(h):
        return h
    n = min(n, len(h))
    out = h[:len(h) - n + 1]
    for k in range(1, n):
        out = mixed(out * MIX_A + h[k:len(h) - n + 1 + k])
    return np.unique(mixed(out + np.uint64(n)))
