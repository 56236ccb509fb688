"""Terms (runs of ASCII letters, digits and non-ASCII characters) of Arrow string
columns and their numbers in a vocabulary, vectorised with numpy.

Only A-Z are lower-cased.  Every ASCII byte that is neither letter nor digit
ends a term, so cutting UTF-8 bytes never splits a character.  A term is
compared by a 128-bit name made from its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from riverbed.llm.words import U64, Spans, mix, row_slices, text_bytes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[97:123] = _TERM[128:] = True
_rng = np.random.Generator(np.random.PCG64(608))
_BYTE = _rng.integers(1, 2**63, size=(2, 256), dtype=np.uint64) * U64(2) + U64(1)
_BASE = [int(x) * 2 + 1 for x in _rng.integers(2**40, 2**62, size=2)]


class Terms:
    """The terms of some texts: ``first[i]:first[i+1]`` are those of row i, ``names`` their two names each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = _LOWER[data]
        n = len(data)
        inside = _TERM[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], inside[:-1])) if n else inside
        after = np.concatenate((inside[1:], [False])) if n else inside
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(start, offsets)
        self.names = [mix(Spans(_BYTE[k][data], _BASE[k]).of(start, end) + (end - start).astype(U64)) for k in (0, 1)]


def each(batch: pa.RecordBatch, text: str):
    """Runs of rows of a batch with their terms."""
    data, offs = text_bytes(batch.column(text))
    for lo, hi in row_slices(offs):
        yield batch.slice(lo, hi - lo), Terms(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])


class Vocabulary:
    """Numbers 0, 1, ... of distinct names, given as rows of two 64-bit halves."""

    def __init__(self, names: np.ndarray):
        self.names = np.unique(names.astype(U64).reshape(-1, 2), axis=0)
        #: Halves alone tell names apart unless two of them collide; then both are compared.
        self.head = np.ascontiguousarray(self.names[:, 0])

    def __len__(self) -> int:
        return len(self.names)

    def numbers(self, names: list[np.ndarray]) -> np.ndarray:
        """The number of each name, -1 where it is unknown."""
        out = np.full(len(names[0]), -1, np.int64)
        if not len(self):
            return out
        at = np.minimum(np.searchsorted(self.head, names[0]), len(self) - 1)
        while True:
            same = self.head[at] == names[0]
            hit = same & (self.names[at, 1] == names[1])
            out[hit] = at[hit]
            go = same & ~hit & (at + 1 < len(self))
            if not go.any():
                return out
            step = np.where(go, at + 1, at)
            if (step == at).all() or not (self.head[step[go]] == names[0][go]).any():
                return out
            at = step
