"""Word shingles of texts as sets of 64-bit numbers, and their minima under many hash functions."""

from __future__ import annotations

import numpy as np
import xxhash

# Words of the cache that turns a word into its hash; beyond that it starts anew.
CACHE_WORDS = 100_000
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
STEP = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hash of each word seen, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words between runs of white space; only A-Z change to lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * MIX_1
    values = (values ^ (values >> np.uint64(27))) * MIX_2
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words.

    A shorter text is one shingle, and a text without words has none.
    """
    words = words_of(text)
    if not words:
        return np.empty(0, dtype=np.uint64)
    values = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(size, len(values))
    runs = np.full(len(values) - size + 1, size, dtype=np.uint64)
    for offset in range(size):
        runs = mixed(runs * STEP + values[offset : len(values) - size + 1 + offset])
    return np.unique(runs)


def hash_family(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and summands of ``count`` universal multiply-shift hash functions."""
    draws = np.random.default_rng(seed).integers(0, 2**64, size=(2, count), dtype=np.uint64)
    return draws[0] | np.uint64(1), draws[1]


def minima(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The smallest 32-bit hash of the set under each function of the family.

    Long sets are taken in pieces, so memory does not grow with the text.
    """
    factors, summands = family
    low = np.full(len(factors), np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, len(shingles), 256):
        piece = shingles[start : start + 256]
        hashed = ((piece[None, :] * factors[:, None] + summands[:, None]) >> np.uint64(32)).astype(
            np.uint32
        )
        np.minimum(low, hashed.min(axis=1), out=low)
    return low
