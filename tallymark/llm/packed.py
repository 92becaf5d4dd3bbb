"""Sorted 64-bit hashes as compact bytes, for shuffles of many of them."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Byte planes of an unsigned integer array, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype=np.uint64) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    """As pack, for ascending values: differences need fewer bytes."""
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.uint64)


def lookup(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted table, -1 if it is not there."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)
