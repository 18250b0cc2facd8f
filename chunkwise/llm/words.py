"""Hashes of the words of many texts at once, without an object per word.

A word's hash is a polynomial in its bytes, taken from running sums over a block of
text; words longer than ``LONG`` bytes get xxhash's. Equal words have equal hashes
wherever they stand.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

#: Bytes of text that are summed at once.
BLOCK = 1 << 18
LONG = 64
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[*range(9, 14), 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(11).integers(0, 1 << 64, 256, np.uint64)


def _powers(base: int) -> np.ndarray:
    out = np.full(BLOCK + LONG + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWERS, _INVERSES = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts (ASCII letters lower-cased), and each text's number of words."""
    whole = b" ".join(raws).lower()
    begins, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(whole):
        blank = _BLANK.search(whole, at + BLOCK)  # all words of a block begin among its first BLOCK bytes
        end = blank.end() if blank else len(whole)
        codes = np.frombuffer(whole, np.uint8, end - at, at)
        turn = np.diff(_IS_BLANK[codes].view(np.int8), prepend=1, append=1)
        start, stop = np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)
        size = min(len(codes), BLOCK + LONG)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTES[codes[:size]] * _POWERS[:size], out=sums[1:])
        h = (sums[np.minimum(stop, size)] - sums[start]) * _INVERSES[start]
        for i in np.flatnonzero(stop - start > LONG):
            h[i] = xxhash.xxh3_64_intdigest(whole[at + start[i]:at + stop[i]])
        begins.append(at + start)
        hashes.append(mix(h))
        at = end
    edges = np.cumsum([0] + [len(raw) + 1 for raw in raws])
    return np.concatenate(hashes), np.diff(np.searchsorted(np.concatenate(begins), edges))
