"""Word and n-gram hashing over Arrow string columns, vectorised with numpy.

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D`` (all
ASCII, so cutting UTF-8 bytes never splits a character).  Word names are pairs
of 64-bit polynomial hashes taken from prefix sums over the bytes; the name of
any span of words comes from prefix sums over the word names, so a window of
any length costs two subtractions.  Names depend on content only: every task
gives equal spans equal names without a dictionary or a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, size=(2, 256), dtype=np.uint64) * U64(2) + U64(1)
_BASE = [int(x) * 2 + 1 for x in _rng.integers(2**40, 2**62, size=4)]
_POW: dict[int, np.ndarray] = {}

SLICE_BYTES = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    base %= 1 << 64
    have = _POW.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U64)
        have[0] = 1
        have = np.cumprod(have, dtype=U64)
        _POW[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """An invertible scrambling of 64-bit values (a permutation of 0..2**64-1)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Spans:
    """Hashes of any span of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values * _powers(base, n), dtype=U64, out=self.sums[1:])
        self.undo = _powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.undo[start]


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows (null: empty)."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if col.null_count:
        col = col.fill_null("")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows holding about ``limit`` bytes each (a longer row stands alone),
    so that temporary arrays stay small whatever the Arrow batch holds."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class Words:
    """The words of some texts: byte spans, owning row, and two names each.

    ``first[i]:first[i+1]`` are the words of row i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        if lower:
            data = _LOWER[data]
        n = len(data)
        word = ~_SEP[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = word[:-1]
        after = np.zeros(n, bool)
        after[:-1] = word[1:]
        self.data = data
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.names = [mix(Spans(_BYTE[k][data], _BASE[k]).of(self.start, self.end)
                          + (self.end - self.start).astype(U64)) for k in (0, 1)]

    def spans(self, which: int = 0) -> Spans:
        return Spans(self.names[which], _BASE[2 + which])
