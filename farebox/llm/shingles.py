"""Word shingle sets of whole texts, as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pandas as pd

WORDS = 5
_B = np.uint64(0x9E3779B97F4A7C17)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a hash over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; other letters stay as they are."""
    return text.encode().lower().split()


def shingle_sets(texts: list[str], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the distinct shingles of text i are ``hashes[ends[i - 1]:ends[i]]``, ascending.

    A text of fewer than ``size`` words is one shingle of them all; without words it has none.
    """
    split = [words_of(text) for text in texts]
    counts = np.array([len(w) for w in split], np.int64)
    flat = np.empty(counts.sum(), object)
    flat[:] = [w for words in split for w in words]
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    h = mixed(pd.util.hash_array(flat, categorize=False))
    doc = np.repeat(np.arange(len(texts)), counts)
    # Short texts: a shingle that starts at their first word and takes what there is.
    first = np.cumsum(counts) - counts
    left = (first + counts)[doc] - np.arange(len(h))
    whole = (left >= size) | ((counts[doc] < size) & (left == counts[doc]))
    out = np.zeros(len(h), np.uint64)
    taken = np.minimum(counts[doc], size).astype(np.uint64)
    for k in range(size):
        nxt = np.zeros(len(h), np.uint64)
        nxt[: len(h) - k] = h[k:]
        out = np.where(k < taken, out * _B + nxt, out)
    key, doc = mixed(out + taken)[whole], doc[whole]
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    return key[new], np.cumsum(np.bincount(doc[new], minlength=len(texts)))
