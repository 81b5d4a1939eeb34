"""Word and shingle hashes of whole texts as numpy arrays, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

MOST_WORDS = 1_000_000
MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(31)


class WordHashes(dict):
    """Remembers the hash of each word; starts afresh when it holds ``MOST_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def word_list(text: str | None, lower: bool) -> list[bytes]:
    """Words between runs of ASCII white space; ``lower`` folds A-Z only."""
    if not text:
        return []
    data = text.encode("utf-8", "surrogatepass")
    return (data.lower() if lower else data).split()


def multipliers(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers from a seed."""
    drawn = [xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed) | 1 for i in range(count)]
    return np.array(drawn, dtype=np.uint64)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j, m in enumerate(multipliers(size, 17)):
        total += words[j : j + n] * m
    total ^= total >> FOLD
    return total * MIX


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle of all its words."""
    if len(words) == 0:
        return np.zeros(0, dtype=np.uint64)
    return np.unique(run_hashes(words, min(size, len(words))) ^ np.uint64(min(size, len(words))))
