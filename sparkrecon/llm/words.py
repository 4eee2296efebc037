"""Words of whole texts as 64-bit hashes, column-wise."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from .tokens import pieces

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (splitmix64's finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _A
    x = x ^ (x >> np.uint64(27))
    x = x * _B
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word in turn, where each text's words start; one more entry than texts).

    Words are runs without ASCII white space; ``lower`` folds A-Z. Null and blank texts have none.
    """
    coded, starts = pieces(texts)
    words = pc.ascii_trim_whitespace(coded.dictionary)
    if lower:
        words = pc.ascii_lower(words)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(starts), np.int64)
    each = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)
    blank = pc.binary_length(words).to_numpy() == 0
    at = coded.indices.to_numpy()
    if not blank.any():
        return each[at], starts
    real = ~blank[at]
    return each[at[real]], np.concatenate([[0], np.cumsum(real)])[starts]


def shingles(hashes: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``width`` words, the text of each). A shorter text is one run."""
    counts = np.diff(starts)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(counts)), runs)
    at = starts[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs)
    found = np.minimum(counts, width)[doc].astype(np.uint64)
    end = starts[1:][doc]
    for i in range(width):
        inside = at + i < end
        word = np.where(inside, hashes[np.minimum(at + i, max(len(hashes) - 1, 0))], np.uint64(0)) if len(hashes) else found
        found = mixed(found * _STEP + word)
    return found, doc


def occurrences(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each value, how many equal ones of the same text come before it (in some fixed order)."""
    order = np.lexsort((values, doc))
    v, d = values[order], doc[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    at = np.arange(len(v))
    out = np.empty(len(v), np.int64)
    out[order] = at - np.maximum.accumulate(np.where(first, at, 0))
    return out
