"""The perfect binary Golay code (23, 12, 7) as lookup tables for arrays of 23-bit words.

Every 23-bit word lies within 3 bits of exactly one codeword.  A word at distance 3 has five more
codewords at distance 4, any other word none; so a word has one or six codewords within distance
4.  Two words that differ in at most 2 bits always share one of them: the codeword nearest to a
word half way between lies within 3 + 1 bits of both.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np

BITS, DATA, PARITY = 23, 12, 11
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
GENERATOR = 0b110001110101
KEYS = 6


def syndrome(words: np.ndarray) -> np.ndarray:
    """The remainder of each word after division by the generator."""
    rest = words.astype(np.int64)
    for k in range(BITS - 1, PARITY - 1, -1):
        rest = np.where(rest >> k & 1, rest ^ (GENERATOR << (k - PARITY)), rest)
    return rest


@cache
def tables() -> np.ndarray:
    """For each syndrome, what turns a word into its codewords within distance 4: the nearest first, -1 where there are fewer."""
    patterns = np.array([sum(1 << i for i in c) for n in range(4) for c in combinations(range(BITS), n)], np.int64)
    error = np.zeros(1 << PARITY, np.int64)
    error[syndrome(patterns)] = patterns
    every = np.arange(1 << DATA, dtype=np.int64) << PARITY
    codewords = every ^ syndrome(every)
    of_seven = codewords[np.bitwise_count(codewords) == 7]
    out = np.full((1 << PARITY, KEYS), -1, np.int64)
    out[:, 0] = error
    for s in np.flatnonzero(np.bitwise_count(error) == 3):
        near = of_seven[(of_seven & error[s]) == error[s]]
        out[s, 1 : 1 + len(near)] = error[s] ^ near
    return out


def near_codewords(words: np.ndarray) -> np.ndarray:
    """The 12-bit indices of the codewords within distance 4 of each 23-bit word, as a row of six with -1 where there is none."""
    turn = tables()[syndrome(words)]
    return np.where(turn < 0, -1, (words.astype(np.int64)[:, None] ^ turn) >> PARITY)
