"""Words, their hashes and SimHash fingerprints, as numpy arrays inside tasks."""

from __future__ import annotations

import re

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a maximal run of letters or digits of the lower-cased text.
WORD = re.compile(r"[^\W_]+")
#: A task forgets its word hashes when it holds this many; they are only a cache.
CACHE = 500_000
_hashes: dict[str, int] = {}


def in_slabs(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """The batches in pieces of a few rows, so that what is made of them stays small."""
    for batch in batches:
        for begin in range(0, len(batch), rows):
            yield batch.iloc[begin : begin + rows].reset_index(drop=True)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def hash_words(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    if len(_hashes) > CACHE:
        _hashes.clear()
    for w in set(words).difference(_hashes):
        _hashes[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(31) + hashes[k : k + n])
    return out


def window_prints(hashes: np.ndarray, size: int) -> np.ndarray:
    """The SimHash of each window of ``size`` words (at most 255), over its words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(hashes) + 1, 64), np.uint8)
    np.cumsum(bits, axis=0, dtype=np.uint8, out=sums[1:])  # differences hold modulo 256
    return np.packbits((sums[size:] - sums[:-size]) > size // 2, axis=1).view(np.uint64).ravel()


def spark_words(text: Column) -> Column:
    """The same words as an array column."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
