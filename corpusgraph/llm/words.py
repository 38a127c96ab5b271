"""Words of many texts at once, as arrays over the bytes of an Arrow column.

Everything here runs inside Spark tasks on one batch of rows. Words are the longest runs
of bytes other than space and ``\\x09-\\x0D``; in UTF-8 no other character contains these
bytes, so a word of the text is a word of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and ends; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset :][: len(column) + 1]
    values = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return values[bounds[0] : bounds[-1]], bounds - bounds[0]


def row_slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    start, rows = 0, len(bounds) - 1
    while start < rows:
        stop = int(np.searchsorted(bounds, bounds[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


@dataclass
class Words:
    """Words of some texts: text ``i`` has the words ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray  # bytes, and eight more
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, eight bytes of all words at a time."""
        view = np.ndarray(
            (len(self.data) - 7,), dtype="<u8", buffer=self.data, strides=(1,)
        )
        out = self.length.astype(np.uint64) * _K2 + np.uint64(seed)
        out ^= view[self.start] & _MASK[np.minimum(self.length, 8)]
        out = mix(out)
        at, rest = 8, np.flatnonzero(self.length > 8)
        while rest.size:
            part = view[self.start[rest] + at]
            part &= _MASK[np.minimum(self.length[rest] - at, 8)]
            out[rest] = mix(out[rest] ^ part)
            at += 8
            rest = rest[self.length[rest] > at]
        return out


def mix(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    values = values * _K1
    values ^= values >> np.uint64(32)
    values *= _K2
    values ^= values >> np.uint64(29)
    return values


def split_words(data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> Words:
    """The words of texts that lie one after the other in ``data``."""
    size = len(data)
    padded = np.zeros(size + 8, dtype=np.uint8)
    padded[:size] = _LOWER[data] if lower else data
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return Words(padded, none, none, np.zeros(len(bounds), dtype=np.int64))
    inside = ~_SPACE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(bounds) > 0)
    at = bounds[filled]
    begins[at] = inside[at]
    at = bounds[filled + 1] - 1
    ends[at] = inside[at]
    start = np.flatnonzero(begins)
    length = np.flatnonzero(ends) + 1 - start
    return Words(padded, start, length, np.searchsorted(start, bounds))


def batch_words(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of an Arrow column, a few megabytes at a time."""
    data, bounds = text_bytes(column)
    for start, stop in row_slices(bounds):
        part = data[bounds[start] : bounds[stop]]
        yield start, stop, split_words(part, bounds[start : stop + 1] - bounds[start], lower)


def window_hashes(
    hashes: np.ndarray, size: int, base: np.uint64 = _K1
) -> np.ndarray:
    """Rabin-Karp hashes of all runs of ``size`` words, also across texts."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = hashes[:count].copy()
    for k in range(1, size):
        out *= base
        out += hashes[k : count + k]
    return mix(out)


def window_texts(words: Words, size: int) -> np.ndarray:
    """The text of each such run, -1 where the run leaves its text."""
    count = max(0, len(words.start) - size + 1)
    text = words.text_of_word()
    return np.where(text[:count] == text[size - 1 :][:count], text[:count], -1)
