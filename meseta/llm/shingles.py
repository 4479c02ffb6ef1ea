"""Word shingles of whole texts as 64-bit numbers, many documents at a time."""

from __future__ import annotations

import numpy as np
import xxhash

_U64 = np.uint64
# odd multipliers from the fractional bits of square roots, one per place and one for short texts
_PLACES = np.array([int((p ** 0.5 % 1) * 2 ** 52) * 4096 + 2 * p + 1 for p in (2, 3, 5, 7, 11, 13)], _U64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every input bit reaches every output bit."""
    values = values.astype(_U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values ^= values >> _U64(shift)
        values *= _U64(factor)
    return values ^ (values >> _U64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased; ``bytes.split`` parts at the six ASCII spaces."""
    words = text.lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U64, len(words))


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order; a shorter text is one run, no words are none."""
    n = len(words)
    if not n:
        return words
    if n < size:
        return mixed((words * _PLACES[:n]).sum(keepdims=True) + _PLACES[5:] * np.array([n], _U64))
    total = words[:n - size + 1] * _PLACES[0]
    for place in range(1, size):
        total = total + words[place:n - size + 1 + place] * _PLACES[place]
    return mixed(total)


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    return np.unique(shingle_hashes(word_hashes(text), size))
