"""Words and word shingles of many texts at once, as 64-bit hashes, straight from Arrow's buffers.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
with A-Z lower-cased. Hashes depend on nothing but the words, so they agree
between processes and runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_LETTER = np.zeros(256, dtype=np.uint8)
for _a, _b in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
    _LETTER[_a : _b + 1] = np.arange(_a, _b + 1)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_BYTE, _PLACE = constants(256, 1), constants(64, 2)


def texts_of(column: pa.Array, most_bytes: int = 4_000_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about so many bytes; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most_bytes, side="right")) - 1)
        b = min(b, len(column))
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of words of each text)."""
    letter = _LETTER[data]
    inside = letter != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[at] = inside[at]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, offsets))
    if not len(starts):
        return np.empty(0, dtype=_U), counts
    begin = np.flatnonzero(first[inside])
    letter = letter[inside]
    lengths = np.diff(begin, append=len(letter))
    place = np.arange(len(letter)) - np.repeat(begin, lengths)
    hashes = np.add.reduceat(_BYTE[letter] * _PLACE[place & 63] + (place.astype(_U) >> _U(6)), begin)
    return mix(hashes + lengths.astype(_U)), counts


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``size`` words, number of runs of each text); a shorter text with words has one run of all."""
    factors = constants(size, 3)
    ends = np.cumsum(counts)
    starts = ends - counts
    runs = np.maximum(counts - size + 1, np.minimum(counts, 1))
    total = int(counts.sum())
    padded = np.concatenate([hashes, np.zeros(size, dtype=_U)])
    rolled = np.zeros(total, dtype=_U)
    for j in range(size):
        rolled += padded[j : j + total] * factors[j]
    keep = np.arange(total) - np.repeat(starts, counts) < np.repeat(runs, counts)
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        own = hashes[starts[i] : ends[i]]
        rolled[starts[i]] = (own * factors[: len(own)]).sum(dtype=_U) + _U(len(own))
    return mix(rolled[keep]), runs
