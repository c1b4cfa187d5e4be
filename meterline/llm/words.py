"""Words of whole texts as numpy arrays: where they lie, their hashes, and hashes of word runs.

A word is a longest run of bytes other than space and tab to carriage return. Equal words
have equal 64-bit hashes wherever they stand, and so have equal runs of words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U = np.uint64

# Odd, so they can be undone modulo 2^64.
_BYTE_STEP = 0x9E3779B97F4A7C15
_RUN_STEP = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers, one to one (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_POWERS: dict[int, np.ndarray] = {}


def powers(step: int, count: int) -> np.ndarray:
    """step^0 .. step^(count-1) modulo 2^64; the longest table asked for is kept."""
    held = _POWERS.get(step)
    if held is None or len(held) < count:
        size = max(count, 1 << 16)
        factors = np.full(size, U(step), np.uint64)
        factors[0] = 1
        held = _POWERS[step] = np.cumprod(factors, dtype=np.uint64)
    return held[:count]


def inverse(step: int) -> int:
    return pow(step, -1, 1 << 64)


class Words(NamedTuple):
    """The words of some texts: byte ranges, and `bounds`, where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def lower(data: np.ndarray) -> np.ndarray:
    """A to Z as a to z; other bytes, and so other letters, as they are."""
    return _LOWER[data]


def split(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> Words:
    """The words of the texts that lie one after another in `data`, cut at `offsets`; `blank` tells
    for each byte value whether it lies between words."""
    solid = ~blank[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    # Words do not run from one text into the next.
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    begins[cuts] |= solid[cuts]
    ends[cuts - 1] |= solid[cuts - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


def hash_words(data: np.ndarray, words: Words, seed: int = 0) -> np.ndarray:
    values = _BYTE_VALUES if not seed else mix(_BYTE_VALUES + U(seed))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers(_BYTE_STEP, len(data)), out=sums[1:])
    return mix((sums[words.ends] - sums[words.starts]) * powers(inverse(_BYTE_STEP), len(data) + 1)[words.starts])


def hash_prefixes(data: np.ndarray, words: Words, sizes: tuple[int, ...]) -> list[np.ndarray]:
    """Of each size the hash of each word's first bytes, 0 for words that have fewer."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(_BYTE_STEP, len(data)), out=sums[1:])
    back = powers(inverse(_BYTE_STEP), len(data) + 1)[words.starts]
    found = []
    for size in sizes:
        ends = np.minimum(words.starts + size, words.ends)
        hashes = mix(mix((sums[ends] - sums[words.starts]) * back) + U(size))
        found.append(np.where(words.starts + size <= words.ends, hashes, U(0)))
    return found


def hash_runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` consecutive words, by its first word; shorter by size - 1."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_RUN_STEP, len(hashes)), out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * powers(inverse(_RUN_STEP), count))


def runs_inside(words: Words, size: int) -> np.ndarray:
    """Which runs of `size` words, by first word, lie within one text."""
    count = int(words.bounds[-1]) - size + 1
    if count <= 0:
        return np.zeros(0, bool)
    inside = np.ones(count, bool)
    for back in range(1, size):
        cuts = words.bounds[1:-1] - back
        cuts = cuts[(cuts >= 0) & (cuts < count)]
        # A run that begins `back` words before a later text reaches into it.
        inside[cuts] = False
    return inside
