"""Sets of word shingles as arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
#: Odd multipliers, one for each place in a shingle, and one more for texts below ``SHINGLE`` words.
PLACES = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
SHORT = 0xE7037ED1A0B428DB


def spread(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers that loses nothing."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than five words are one shingle, none are none."""
    h = word_hashes(words_of(text))
    if not len(h):
        return h
    n = max(1, len(h) - SHINGLE + 1)
    with np.errstate(over="ignore"):
        if len(h) < SHINGLE:
            out = np.array([SHORT * len(h) % (1 << 64)], np.uint64)
        else:
            out = np.zeros(n, np.uint64)
        for k in range(min(len(h), SHINGLE)):
            out += h[k : k + n] * np.uint64(PLACES[k])
    return np.unique(spread(out))
