"""Sets of word shingles and bands of their minima, for texts as simhash reads them.

A text's tokens are 64-bit hashes of its shingles (a shorter text is one token, one without words has none). Similar texts
share one of BANDS bands of ROWS minima: a pair at a similarity of 0.8 misses all of them with a probability of 1.2e-7, a
closer one with less.
"""

from __future__ import annotations

import numpy as np
import xxhash

from strata.llm.common import mix64

BANDS, ROWS = 40, 5
#: Tokens whose minima are taken at once, so that a very long text needs no more memory than others.
_BLOCK = 4096
_FACTORS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def tokens(text: bytes, shingle: int, seed: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    found = {xxhash.xxh64_intdigest(b" ".join(words[k : k + shingle]), seed) for k in range(max(1, len(words) - shingle + 1))}
    return np.sort(np.fromiter(found, np.uint64, len(found)))


def bands(found: np.ndarray) -> np.ndarray:
    """One hash for each band of minima; none for an empty set."""
    if not len(found):
        return np.zeros(0, np.uint64)
    least = np.full(len(_FACTORS), np.iinfo(np.uint64).max)
    for k in range(0, len(found), _BLOCK):
        least = np.minimum(least, (found[k : k + _BLOCK, None] * _FACTORS).min(axis=0))
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        out = mix64(out ^ column) + np.uint64(1)
    return out
