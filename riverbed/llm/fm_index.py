"""An FM-index over a sequence of term numbers cut into runs by gaps.

Suffixes are sorted by prefix doubling, only those still equal in each round;
gaps differ from each other, so no comparison leaves its run.  The
Burrows-Wheeler transform lies in a wavelet tree, level by level, whose bits are
packed into 64-bit words with running counts; ranks, backward search and the walk
to the next sampled suffix position all work on arrays of queries.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64


class Bits:
    """Bits with rank: ``before(i)`` ones lie before place i."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, U64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.sums = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))
        self.ones = int(self.sums[-1])

    def before(self, i: np.ndarray) -> np.ndarray:
        word = i >> 6
        mask = (U64(1) << (i & 63).astype(U64)) - U64(1)
        return self.sums[word] + np.bitwise_count(self.words[word] & mask)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(U64) & U64(1)).astype(bool)


class WaveletTree:
    """Symbols 0 .. sigma-1 with access and rank, highest bit first."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(int(sigma - 1).bit_length(), 1)
        self.levels, self.zeros = [], []
        for shift in range(self.depth - 1, -1, -1):
            bit = (symbols >> shift & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(len(symbols) - self.levels[-1].ones)
            symbols = np.concatenate((symbols[~bit], symbols[bit]))
        every = np.arange(sigma)
        self.base = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in zip(range(self.depth - 1, -1, -1), self.levels, self.zeros, strict=True):
            one = bits.before(i)
            i = np.where(symbol >> shift & 1, zeros + one, i - one)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before place i."""
        return self._down(symbol, i) - self.base[symbol]

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place i and how often it occurs before."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.levels, self.zeros, strict=True):
            bit, one = bits.at(i), bits.before(i)
            symbol = symbol << 1 | bit
            i = np.where(bit, zeros + one, i - one)
        return symbol, i - self.base[symbol]


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffixes of ``text`` in order.  Symbol 0 is a gap, the last symbol is one,
    and gaps count as different symbols, less than all others, in order of place."""
    n = len(text)
    gap = text == 0
    gaps = int(gap.sum())
    order = np.argsort(np.where(gap, 0, text), kind="stable")
    place = np.empty(n, np.int64)
    key = text[order]
    new = np.concatenate(([True], key[1:] != key[:-1]))
    new[:gaps] = True
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    place[order] = start
    size = np.diff(np.append(np.flatnonzero(new), n))
    live = np.repeat(size > 1, size)
    open_, slot0 = order[live], start[live]
    step = 1
    while len(open_):
        pair = slot0 * n + place[open_ + step]
        turn = np.argsort(pair, kind="stable")
        open_, pair = open_[turn], pair[turn]
        old = slot0  # grouped by slot already, and stays so
        first = np.concatenate(([True], old[1:] != old[:-1]))
        at = np.arange(len(open_))
        slot = old + at - np.maximum.accumulate(np.where(first, at, 0))
        order[slot] = open_
        new = np.concatenate(([True], pair[1:] != pair[:-1]))
        start = slot[np.maximum.accumulate(np.where(new, at, 0))]
        place[open_] = start
        size = np.diff(np.append(np.flatnonzero(new), len(open_)))
        live = np.repeat(size > 1, size)
        open_, slot0 = open_[live], start[live]
        step *= 2
    return order


class FMIndex:
    """Backward search and located occurrences over ``text`` (see ``suffix_array``)."""

    def __init__(self, text: np.ndarray, sigma: int, sample: int = 8):
        self.n, self.sigma = len(text), sigma
        suffix = suffix_array(text)
        self.tree = WaveletTree(text[suffix - 1], sigma)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        # a walk goes back inside its run at most, so the first place of a run is kept too
        keep = (suffix % sample == 0) | (text[suffix - 1] == 0)
        self.kept = Bits(keep)
        self.samples = suffix[keep]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffix order that begin with each phrase, as first and end.

        ``phrases`` has a row for each; symbols are at least 1, -1 fills up short
        ones on the left, and a symbol from sigma on never occurs."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        alive = np.arange(len(phrases))
        for column in phrases.T[::-1]:
            symbol = column[alive]
            more = symbol >= 0
            going, symbol = alive[more], symbol[more]
            both = self.tree.rank(np.concatenate((symbol, symbol)), np.concatenate((lo[going], hi[going])))
            lo[going] = self.less[symbol] + both[:len(going)]
            hi[going] = self.less[symbol] + both[len(going):]
            alive = alive[lo[alive] < hi[alive]]
            if not len(alive):
                break
        return lo, np.maximum(lo, hi)

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows lo .. hi-1 of each range: the range's number and the place in the text."""
        count = hi - lo
        owner = np.repeat(np.arange(len(lo)), count)
        row = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + lo[owner]
        place, steps = np.empty(len(row), np.int64), 0
        open_ = np.arange(len(row))
        while len(open_):
            done = self.kept.at(row)
            place[open_[done]] = self.samples[self.kept.before(row[done])] + steps
            open_, row = open_[~done], row[~done]
            symbol, rank = self.tree.access(row)
            row = self.less[symbol] + rank
            steps += 1
        return owner, place
