"""Word hashes of whole texts and hashes of runs of words."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def word_hashes(words: list[bytes], seed: int = 42) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(seed)), np.uint64, len(words))


def _power(which: int, n: int) -> np.ndarray:
    if len(_powers[which]) < n:
        steps = np.full(max(n, 1 << 12) * 2, (_STEP, _INVERSE)[which], np.uint64)
        steps[0] = 1
        _powers[which] = np.multiply.accumulate(steps)
    return _powers[which][:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words, from the words' own hashes.

    Sums of word hashes times powers of an odd number: the hash of a run is a difference of two
    prefix sums, moved to place 0, so the cost of a run does not depend on its length. Runs of
    different words agree about as seldom as random 64-bit numbers.
    """
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _power(0, len(words)), out=sums[1:])
    return mixed((sums[size:] - sums[:n]) * _power(1, n))
