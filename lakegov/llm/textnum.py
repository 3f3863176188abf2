"""Vectorised byte-level helpers for tasks that get text as Arrow batches.

All work is done on whole texts, in slices of about ``SLICE`` bytes made of
complete documents, so that memory follows the longest document and not the
batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U64 = np.uint64

#: ASCII white space: the bytes 0x20 and 0x09 to 0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has length 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def slices(raw: np.ndarray, at: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of whole documents
    of at most ``most`` bytes, or of one longer document."""
    n, lo = len(at) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[at[lo]: at[hi]], at[lo: hi + 1] - at[lo]
        lo = hi


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i mod 2^64 for i < n."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, SLICE + 1)
        inverse = pow(_BASE, -1, 1 << 64)
        for key, base in (("up", _BASE), ("down", inverse)):
            p = np.full(size, base, U64)
            p[0] = 1
            _POWERS[key] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


#: One random odd 64-bit value per byte value.
_MIX = ((np.arange(1, 257, dtype=np.uint64) * U64(_ODD)) ^ (np.arange(1, 257, dtype=np.uint64) * U64(_BASE) >> U64(17))) | U64(1)


def finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit hash (in place)."""
    h ^= h >> U64(32)
    h *= U64(_BASE)
    h ^= h >> U64(29)
    h *= U64(_ODD)
    h ^= h >> U64(32)
    return h


class PrefixHash:
    """Hash of any substring in O(1): sums of mixed bytes times base powers."""

    def __init__(self, raw: np.ndarray):
        self.up, self.down = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, U64)
        np.cumsum(_MIX[raw] * self.up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.down[start]
        h += (end - start).astype(U64) * U64(_ODD)
        return finish(h)


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of the first word of each document, with the total
    appended): words are runs without ASCII white space, within a document."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    space = IS_SPACE[raw]
    inside = ~space
    begins = inside.copy()
    begins[1:] &= space[:-1]
    cuts = at[(at > 0) & (at < len(raw))]
    begins[cuts] = inside[cuts]
    starts = np.flatnonzero(begins)
    ends_mask = inside.copy()
    ends_mask[:-1] &= space[1:]
    ends_mask[cuts - 1] = inside[cuts - 1]
    ends = np.flatnonzero(ends_mask) + 1
    return starts, ends, np.searchsorted(starts, at)
