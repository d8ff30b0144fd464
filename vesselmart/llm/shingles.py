"""Five-word shingle sets of texts as sorted 64-bit hashes, batch-wise."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash

SHINGLE = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters its input."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: list[list[bytes]], seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, end to end, and the words of each text."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [w for some in words for w in some]
    codes, distinct = pd.factorize(flat)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter((digest(w, seed) for w in distinct), np.uint64, len(distinct))
    return hashes[codes] if len(codes) else np.zeros(0, np.uint64), sizes


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, end to end and sorted, and how many each has.

    Words are runs of ``[^\\x20\\x09-\\x0D]`` with A-Z in lower case. A text of
    fewer than five words has its whole sequence as its one shingle; one without
    words has none.
    """
    hashes, sizes = word_hashes([t.encode().lower().split() for t in texts])
    grams = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    text = np.repeat(np.arange(len(texts)), grams)
    at = np.arange(len(text)) - np.repeat(np.cumsum(grams) - grams, grams)
    at += np.repeat(np.cumsum(sizes) - sizes, grams)
    value = np.zeros(len(text), np.uint64)
    left = np.minimum(sizes, SHINGLE)[text]
    padded = np.concatenate([hashes, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        word = np.where(k < left, padded[at + k], np.uint64(k + 1))  # k + 1: no word here
        value = mix(value * _ODD + word)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    return value[fresh], np.bincount(text[fresh], minlength=len(texts))
