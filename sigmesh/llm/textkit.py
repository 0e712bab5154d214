"""Vectorised words and word hashes over Arrow text columns.

Words are maximal runs of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return. A chunk holds whole texts only, so
memory is bounded by ``max_bytes`` or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if len(have) <= 1 << 22:  # tables for longer texts are not kept
            _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The 64-bit finaliser of splitmix, a bijection."""
    x = x + np.uint64((seed * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Some whole texts: rows ``lo`` to ``hi`` of a batch, their bytes, and offsets of each text."""

    def __init__(self, lo: int, hi: int, buf: np.ndarray, off: np.ndarray):
        self.lo, self.hi, self.buf, self.off = lo, hi, buf, off

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the index of its first word (one more at the end)."""
        if not len(self.buf):
            none = np.zeros(0, dtype=np.int64)
            return none, none, np.zeros(len(self.off), dtype=np.int64)
        inside = ~SPACE[self.buf]
        cut = np.zeros(len(self.buf) + 1, dtype=bool)
        cut[self.off] = True
        before = np.empty_like(inside)
        before[0] = False
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.empty_like(inside)
        after[-1] = False
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.off)

    def sums(self, table: np.ndarray = SAME) -> np.ndarray:
        """Running polynomial sums of the bytes mapped by ``table``; ``spans`` hashes any substring from them."""
        n = len(self.buf)
        out = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((table[self.buf].astype(np.uint64) + np.uint64(1)) * _powers(_BASE, n), out=out[1:], dtype=np.uint64)
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the substrings from ``starts`` to ``ends``."""
        inv = _powers(_INVERSE, len(self.buf) + 1)
        return mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def chunks(col: pa.Array | pa.ChunkedArray, max_bytes: int = 1 << 21) -> Iterator[Chunk]:
    """Cut a text column into chunks of whole texts; null counts as empty."""
    parts = col.chunks if isinstance(col, pa.ChunkedArray) else [col]
    base = 0
    for arr in parts:
        arr = arr.cast(pa.large_binary()).fill_null(b"")
        n = len(arr)
        _, offs, data = arr.buffers()
        off = np.frombuffer(offs, dtype=np.int64)[arr.offset:arr.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        lo = 0
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1)
            hi = min(hi, n)
            yield Chunk(base + lo, base + hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            lo = hi
        base += n


def windows(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of all runs of ``size`` words inside one text, and per text the index of its first run."""
    counts = np.diff(first)
    runs = np.maximum(counts - size + 1, 0)
    begin = np.concatenate([[0], np.cumsum(runs)])
    pos = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], runs)
    return pos, begin


def combine(words: np.ndarray, pos: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words that start at ``pos``."""
    h = np.zeros(len(pos), dtype=np.uint64)
    for j in range(size):
        h = mix(h + words[pos + j], j + 1) if j + 1 < size else h * np.uint64(0xFF51AFD7ED558CCD) + words[pos + j]
    return mix(h, size)
