"""Terms of many texts as codes of one dictionary, and packed lists of ascending numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from siltstone.llm.kernels import lower_ascii


def bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes lie in one of the ranges, both ends included."""
    inside = np.zeros(256, bool)
    for low, high in ranges:
        inside[low : high + 1] = True
    return inside


LETTERS = bytes_in((0x61, 0x7A), (0x80, 0xFF))
LETTERS_AND_DIGITS = bytes_in((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def coded_terms(data: np.ndarray, bounds: np.ndarray, allowed: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms in bytewise order, the code of every term, and the first term of each text (with the end).

    Terms are the longest runs of ``allowed`` bytes once A to Z are lower case; texts lie end to end in ``data``
    and start at ``bounds``. Codes come from the terms themselves, not from hashes.
    """
    if not len(data):
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    low = lower_ascii(data)
    inside = allowed[low]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    wide = offsets[-1] >= 1 << 31
    offsets = offsets.astype(np.int64 if wide else np.int32)
    kind = pa.large_string() if wide else pa.string()
    words = pa.Array.from_buffers(kind, len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low[inside])])
    coded = words.dictionary_encode()
    order = np.asarray(pc.sort_indices(coded.dictionary))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return coded.dictionary.take(pa.array(order)), rank[np.asarray(coded.indices)], np.searchsorted(starts, bounds)


def packed(values: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of ascending numbers as bytes: seven bits of each difference a byte, the last byte below 128.

    ``firsts`` says where each list starts in ``values`` (with the end); no list is empty. Returns the bytes and where
    each list's bytes start.
    """
    steps = np.diff(values, prepend=0)
    steps[firsts[:-1]] = values[firsts[:-1]]
    size = np.ones(len(steps), np.int64)
    for bits in range(7, 64, 7):
        more = steps >= 1 << bits
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    begin = ends - size
    for k in range(int(size.max()) if len(size) else 0):
        some = np.flatnonzero(size > k)
        part = (steps[some] >> (7 * k)) & 0x7F
        out[begin[some] + k] = part | np.where(size[some] > k + 1, 0x80, 0)
    return out, np.concatenate([[0], ends])[firsts]


def unpacked(data: bytes) -> np.ndarray:
    """The numbers of one packed list."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(raw < 0x80)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.cumsum(np.add.reduceat((raw & 0x7F).astype(np.int64) << (7 * place), starts))
