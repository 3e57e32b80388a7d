"""Words, hashes and shingles of whole texts, for a run of rows at a time, in numpy.

A word is a longest stretch of bytes other than space and 0x09-0x0D, with A-Z lower-cased. As
those bytes never occur inside a longer UTF-8 character, this equals the same rule on characters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed seeds: hashes must be the same on every machine and in every run.
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_GRAM = np.uint64(0xD6E8FEB86659FD93)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Spaces and all other ASCII characters that are neither letters nor digits.
_MARKS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64; up to 8 million of them are kept."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        both = []
        for base in (_BASE, _BASE_INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            both.append(np.cumprod(table, dtype=np.uint64))
        if size > 1 << 23:
            return both[0], both[1]
        _powers[:] = both
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and where each row's text begins (one entry more than rows).

    A null text is an empty one.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Words of some rows: one 64-bit hash each; row r holds ``first[r]`` up to ``first[r+1]``."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words_of(texts: pa.Array, split_at_marks: bool = False) -> Words:
    """The words of every row; ``split_at_marks`` cuts at ASCII punctuation as well."""
    data, offsets = text_bytes(texts)
    n = len(data)
    if n == 0:
        return Words(np.empty(0, np.uint64), np.zeros(len(offsets), np.int64))
    inside = ~(_MARKS if split_at_marks else _SPACE)[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < n)]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    hashes = span_hashes(_LOWER[data], start, end)
    return Words(hashes, np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash for the bytes of each span."""
    n = len(data)
    power, inverse = _power_tables(n)
    run = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=run[1:])
    return mix((run[end] - run[start]) * inverse[start] + _BASE)


def shingle_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each run of ``width`` words, and where each row's begin.

    A row with fewer words has one shingle, its whole sequence; a row without words has none.
    """
    counts = words.counts
    n_grams = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(n_grams, out=first[1:])
    total = len(words.hashes)
    rolled = np.zeros(max(0, total - width + 1), np.uint64)
    for j in range(width):
        rolled = rolled * _GRAM + words.hashes[j : j + len(rolled)]
    rolled = mix(rolled + np.uint64(width))
    out = np.empty(first[-1], np.uint64)
    full = counts >= width
    # Place, in the sequence of all words, of every shingle of the rows that are long enough.
    long_rows = np.flatnonzero(full)
    if len(long_rows):
        reps = n_grams[long_rows]
        shift = np.repeat(words.first[long_rows] - (np.cumsum(reps) - reps), reps)
        places = np.arange(reps.sum()) + shift
        target = np.repeat(full, n_grams)
        out[target] = rolled[places]
    for row in np.flatnonzero((counts > 0) & ~full):
        value = np.zeros(1, np.uint64)
        for place in range(words.first[row], words.first[row + 1]):
            value = value * _GRAM + words.hashes[place]
        out[first[row]] = mix(value + np.uint64(counts[row]))[0]
    return out, first
