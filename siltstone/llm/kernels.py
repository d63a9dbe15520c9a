"""Numpy kernels over UTF-8 bytes: words, rolling fingerprints, sliding minima.

Every kernel works on the bytes of many documents laid end to end; ``bounds`` holds where
each document starts, with the end of the last one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for at, base in enumerate((BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[at] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Rolling:
    """Fingerprints of any span of a byte array from one pass of prefix sums."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=self._sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        raw = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mix(raw + length * np.uint64(0xD6E8FEB86659FD93))

    def windows(self, width: int) -> np.ndarray:
        """Fingerprints of all spans of ``width`` bytes, by start."""
        raw = (self._sums[width:] - self._sums[:-width]) * self._inverse[: len(self._sums) - width]
        return mix(raw + np.uint64(width * 0xD6E8FEB86659FD93 % (1 << 64)))


def leftmost_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the position of its smallest, the leftmost of equals."""
    low, at, size = values, np.arange(len(values), dtype=np.int32), 1
    while size < width:
        step = min(size, width - size)
        right, right_at = low[step:], at[step:]
        left, left_at = low[: len(right)], at[: len(right)]
        smaller = right < left
        low, at = np.where(smaller, right, left), np.where(smaller, right_at, left_at)
        size += step
    return at


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string or binary column; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents with at most ``limit`` bytes each, or of one longer document."""
    first, count = 0, len(bounds) - 1
    while first < count:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, last
        first = last


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes 0x20 and 0x09 to 0x0D, the separators of words."""
    return (data == 0x20) | ((data - np.uint8(9)) < 5)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data - np.uint8(65)) < 26, data + np.uint8(32), data)


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each document's first word (with the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~is_space(data)
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, ...`` of every span, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
