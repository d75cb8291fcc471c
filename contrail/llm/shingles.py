"""Hashed word shingles of whole texts, with numpy inside Spark tasks."""

from __future__ import annotations

import numpy as np
import xxhash

U64 = np.uint64
# odd multipliers, one per word of a shingle, and two for the final mixing
_FACTORS = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9),
            U64(0x27D4EB2F165667C5), U64(0x85EBCA77C2B2AE63)]
_MIX = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


class WordHashes(dict):
    """64-bit hashes of words; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 300_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(30))
    x = x * _MIX[0]
    x = x ^ (x >> U64(27))
    x = x * _MIX[1]
    return x ^ (x >> U64(31))


def shingle_set(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words, A-Z lowered.

    A text with fewer words is one shingle, a text without words has none.
    Words are separated by ASCII white space.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, U64)
    h = np.fromiter(map(hashes.__getitem__, words), U64, len(words))
    n = len(h) - size + 1
    if n < 1:
        # the length keeps a short text apart from shingles of full size
        return mixed((h * np.arange(3, 2 * len(h) + 3, 2, dtype=U64)).sum(keepdims=True)
                     + U64(len(h)))
    total = h[:n] * _FACTORS[0]
    for k in range(1, size):
        total = total + h[k:k + n] * _FACTORS[k]
    return np.unique(mixed(total))


def set_id(tokens: np.ndarray) -> int:
    """A signed 64-bit id of a token set."""
    return int(np.int64(U64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64)))
