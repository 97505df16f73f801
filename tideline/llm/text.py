"""Vectorised tokenising and hashing of Arrow text columns, used inside tasks.

Everything here works on one slice of a record batch at a time, so memory is
bounded by ``SLICE`` bytes of text (or by one text, if that is longer).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2 << 20  # bytes of text handled at a time
SEGMENT = 1 << 18  # bytes hashed at a time
_P = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _inverse(p: int) -> int:
    return pow(p, -1, 1 << 64)


def space_words() -> np.ndarray:
    """Byte map for words ``[^\\x20\\x09-\\x0D]+``: A-Z lower-cased, separators 0."""
    t = np.arange(256, dtype=np.uint16) + 1
    t[0x41:0x5B] += 32
    t[[0x20, *range(0x09, 0x0E)]] = 0
    return t


def letter_words() -> np.ndarray:
    """Byte map for words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    t = np.arange(256, dtype=np.uint16) + 1
    t[0x41:0x5B] += 32
    for lo, hi in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        t[lo : hi + 1] = 0
    return t


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (well spread in every bit)."""
    h = h ^ (h >> np.uint64(33))
    h *= _MIX1
    h ^= h >> np.uint64(33)
    h *= _MIX2
    h ^= h >> np.uint64(33)
    return h


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``P**i`` and ``P**-i`` modulo 2**64 for ``i`` up to ``n``."""
    if "p" not in _POWERS or len(_POWERS["p"]) <= n:
        m = max(n + 1, 2 * SEGMENT)
        for key, base in (("p", int(_P)), ("i", _inverse(int(_P)))):
            a = np.full(m, np.uint64(base), dtype=np.uint64)
            a[0] = 1
            _POWERS[key] = np.cumprod(a, dtype=np.uint64)
    return _POWERS["p"], _POWERS["i"]


def slices(column, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string or binary column into runs of rows of about ``limit`` bytes.

    Yields ``(first, last, data, offsets)``: the bytes of the rows ``first`` to
    ``last - 1`` and where each begins, with the end as the last entry.  Nulls are empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        lo, hi = int(offsets[first]), int(offsets[last])
        yield first, last, data[lo:hi], offsets[first : last + 1] - lo
        first = last


class Words:
    """Words of several texts: begin, end and hash of each, and how many each text has."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        self.data, self.offsets, self.table = data, offsets, table
        starts, ends, hashes = [], [], []
        lo, n = 0, len(data)
        while lo < n:
            hi = self._cut(min(lo + SEGMENT, n))
            s, e, h = self._segment(lo, hi)
            starts.append(s)
            ends.append(e)
            hashes.append(h)
            lo = hi
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    def _cut(self, at: int) -> int:
        """The first position from ``at`` on where no word goes on."""
        n = len(self.data)
        if at >= n:
            return n
        next_text = int(self.offsets[np.searchsorted(self.offsets, at)])
        step = 4096
        while at < next_text:
            gap = np.flatnonzero(self.table[self.data[at : min(at + step, next_text)]] == 0)
            if len(gap):
                return at + int(gap[0])
            at, step = min(at + step, next_text), step * 2
        return next_text

    def _segment(self, lo: int, hi: int):
        c = self.table[self.data[lo:hi]]
        inside = c != 0
        before = np.empty(len(c) + 1, dtype=bool)
        before[0] = False
        before[1:] = inside
        after = before[1:].copy()
        after[:-1] = inside[1:]
        after[-1] = False
        i, j = np.searchsorted(self.offsets, [lo, hi])
        edges = self.offsets[i:j] - lo  # a text begins here, even if the one before ends in a word
        before[edges] = False
        after[edges[edges > 0] - 1] = False
        s = np.flatnonzero(inside & ~before[:-1])
        e = np.flatnonzero(inside & ~after) + 1
        p, inv = powers(len(c) + 1)
        total = np.empty(len(c) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(c.astype(np.uint64) * p[: len(c)], out=total[1:])
        h = mix((total[e] - total[s]) * inv[s] + (e - s).astype(np.uint64) * _MIX1)
        return s + lo, e + lo, h

    def owner(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``k`` words within one text."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        own = self.owner()
        first = np.flatnonzero(own[:n] == own[k - 1 :])
        h = np.full(len(first), np.uint64(k), dtype=np.uint64)
        for j in range(k):
            h = h * _P + self.hashes[first + j]
        return first, mix(h)

    def joined(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last - 1``, lower-cased, with a blank between."""
        t = self.table
        out = [(t[self.data[self.starts[i] : self.ends[i]]] - 1).astype(np.uint8).tobytes() for i in range(first, last)]
        return b" ".join(out)
