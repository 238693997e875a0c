"""Hashes of word shingles for whole batches of texts, in numpy.

A word's hash is a polynomial over its bytes modulo 2^64, taken from running sums over the
whole batch; a shingle's hash mixes those of its words. A-Z are lower-cased.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from kindred.llm.common import WHITE

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_WORD = np.ones(256, bool)
_IS_WORD[np.frombuffer(WHITE.encode(), np.uint8)] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 … base^(n-1) modulo 2^64, kept for the next batch."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 20), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column, and where each begins (and the end)."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a batch, and the number of words before each text."""
    raw, begins = text_bytes(column)
    n = len(raw)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    inside = _IS_WORD[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = begins[1:-1][begins[1:-1] < n]
    begin[edges] = inside[edges]  # a text's first byte begins a word whatever stands before
    starts = np.flatnonzero(begin)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLD[raw].astype(np.uint64) + np.uint64(1)) * _power(_BASE, n) * inside, out=sums[1:])
    # White space adds nothing, so a word's sum runs to the start of the next.
    ends = np.append(starts[1:], n)
    hashes = mix((sums[ends] - sums[starts]) * _power(_INVERSE, n)[starts])
    return hashes, np.searchsorted(starts, begins)


def document_shingles(column: pa.Array, size: int):
    """For each text its sorted distinct shingle hashes. A text with fewer words than
    ``size`` has one shingle of them all; a text without words has none."""
    hashes, before = words(column)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(hashes)
    windows = np.zeros(max(0, n - size + 1), np.uint64)
    for j in range(size):
        windows += hashes[j : j + len(windows)] * factors[j]
    windows = mix(windows)
    for first, last in zip(before[:-1].tolist(), before[1:].tolist()):
        count = last - first
        if count >= size:
            found = np.sort(windows[first : last - size + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        elif count:
            whole = (hashes[first:last] * factors[:count]).sum(dtype=np.uint64) + np.uint64(count)
            yield mix(np.array([whole], np.uint64))
        else:
            yield np.empty(0, np.uint64)
