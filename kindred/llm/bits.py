"""Whole numbers in a fixed number of bits each, eight numbers to ``width`` bytes."""

from __future__ import annotations

import numpy as np


def bits_for(vocabulary: int) -> int:
    """Bits that tell ``vocabulary`` ids apart."""
    return max(1, int(vocabulary - 1).bit_length())


def packed_bytes(n: int, width: int) -> int:
    return -(-n // 8) * width


def _lanes(width: int):
    """For each of eight numbers: its first byte, its shift there, the bytes it touches."""
    for k in range(8):
        byte, shift = divmod(k * width, 8)
        yield k, byte, shift, -(-(shift + width) // 8)


def pack(ids: np.ndarray, width: int) -> bytes:
    rows = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    rows.reshape(-1)[: len(ids)] = ids
    out = np.zeros((len(rows), width), np.uint8)
    for k, byte, shift, touched in _lanes(width):
        shifted = rows[:, k] << np.uint64(shift)
        for j in range(touched):
            out[:, byte + j] |= (shifted >> np.uint64(8 * j)).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, n: int, width: int) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8, packed_bytes(n, width)).reshape(-1, width)
    out = np.empty((len(rows), 8), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k, byte, shift, touched in _lanes(width):
        value = np.zeros(len(rows), np.uint64)
        for j in range(touched):
            value |= rows[:, byte + j].astype(np.uint64) << np.uint64(8 * j)
        out[:, k] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]
