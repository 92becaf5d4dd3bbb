"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes other than the space and 0x09-0x0D, so UTF-8 text needs no decoding.
Texts are taken in slices of about a megabyte; only a text that is longer by itself makes a
longer slice. Hashes are 64 bits wide and the same in every process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1_000_000
_HASH_BLOCK = 1_000_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_STEP = np.uint64(0xA0761D6478BD642F)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse."""
    global _powers
    if _powers is None or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        tables = []
        for base in (_BASE, inverse):
            table = np.full(max(n, _HASH_BLOCK + 4096), base, dtype=np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers = tables[0], tables[1]
    return _powers


@dataclass
class Texts:
    """Consecutive texts of one batch: their bytes, and where each begins and ends."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a text column into slices of about limit bytes; a null counts as empty."""
    first = 0
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        chunk = pc.fill_null(chunk.cast(pa.large_binary()), b"")
        if not len(chunk):
            continue
        _, offsets, data = chunk.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        at = 0
        while at < len(chunk):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            end = min(end, len(chunk))
            yield Texts(first + at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
            at = end
        first += len(chunk)


@dataclass
class Words:
    """Words of a slice in order: byte spans, number of their text, hash."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray
    firsts: np.ndarray

    def positions(self) -> np.ndarray:
        """Place of each word in its text."""
        return np.arange(len(self.text)) - np.repeat(self.firsts, self.counts)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash the byte spans, which are in order and do not overlap."""
    return hash_runs(data, starts, ends, lambda part: _BYTE_VALUE[part])


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, value=lambda part: part) -> np.ndarray:
    """Hash runs of values, which are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        low = int(starts[at])
        end = max(at + 1, int(np.searchsorted(ends, low + _HASH_BLOCK, "right")))
        high = int(ends[end - 1])
        power, inverse = _power_tables(high - low + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(value(data[low:high]) * power[: high - low], out=sums[1:])
        s, e = starts[at:end] - low, ends[at:end] - low
        out[at:end] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * _GOLDEN)
        at = end
    return out


def words(texts: Texts, lower: bool = False) -> Words:
    data, offsets = texts.data, texts.offsets
    if lower:
        data = LOWER[data]
    solid = ~IS_SPACE[data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    full = offsets[1:] > offsets[:-1]
    begins[offsets[:-1][full]] = solid[offsets[:-1][full]]
    stops[offsets[1:][full] - 1] = solid[offsets[1:][full] - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(text, minlength=texts.count)
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1])).astype(np.int64)
    return Words(starts, ends, text, hash_spans(data, starts, ends), counts, firsts)


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of size words inside one text, and where each starts."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    total = hashes[at]
    for k in range(1, size):
        total = total * _STEP + hashes[at + k]
    return mix(total), at


def sum_by_text(values: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
    return np.bincount(text, weights=values, minlength=count).astype(np.int64)


def code_points(data: np.ndarray) -> np.ndarray:
    """Marks the bytes that begin a code point."""
    return (data & 0xC0) != 0x80


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the lines between newlines, and the number of their text."""
    breaks = np.flatnonzero(texts.data == 0x0A)
    owner = np.searchsorted(texts.offsets, breaks, "right") - 1
    own = np.arange(texts.count)
    text = np.concatenate((own, owner))
    starts = np.concatenate((texts.offsets[:-1], breaks + 1))
    ends = np.concatenate((breaks, texts.offsets[1:]))
    order = np.lexsort((starts, text))
    close = np.lexsort((ends, np.concatenate((owner, own))))
    return starts[order], ends[close], text[order]


def sums_between(marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Number of marks in each span."""
    total = np.concatenate(([0], np.cumsum(marks)))
    return total[ends] - total[starts]


def as_lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """One list per text from values in text order."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
