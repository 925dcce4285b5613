"""Words of a whole batch of texts as flat arrays, and 64-bit hashes that are alike on every machine."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd

# Odd 64-bit multipliers of well-known integer mixers.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX_2
    return x ^ (x >> np.uint64(31))


def hashed(words: list) -> np.ndarray:
    """A 64-bit hash of each word; equal words are hashed once."""
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=True)


def flat(parts: Sequence[list]) -> tuple[list, np.ndarray]:
    """All items in a row, and how many each part has."""
    return [w for p in parts for w in p], np.fromiter(map(len, parts), np.int64, len(parts))


def windows(hashes: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of `width` consecutive words inside one text: (hash, text, place of the first word).

    A text of fewer words has none.
    """
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.flatnonzero(owner[:n] == owner[width - 1 :])
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = (out + hashes[k : k + n]) * _GOLDEN
        out ^= out >> np.uint64(29)
    return mix(out)[inside], owner[inside], inside
