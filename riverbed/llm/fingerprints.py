"""Document fingerprints from prefix polynomial hashes.

``Prefixes`` holds, for two primes, the value of every prefix of a text as a
polynomial in a fixed base.  Any span's hash is a difference of two prefixes,
so spans of two texts are compared in constant time and their longest common
extension is found by binary search.  The fingerprint is the length with both
full values; the likeness of two texts is the share of the longer one that a
common start and a common end cover, found from the prefix arrays.  The share of
all common spans goes on between the two: span hashes of the other text's blocks
are looked up at every place, and each common block is extended to both sides.
"""

from __future__ import annotations

import hashlib
from bisect import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.frames import parts, ready

PRIMES, BASES = (2147483647, 2147483629), (131071 * 7 + 4, 524287 * 3 + 2)
#: Rows of a chunk of neighbouring ids, and most chunks (then chunks grow).
CHUNK_ROWS, MOST_CHUNKS = 512, 1 << 14
#: Characters of a block; a common span of twice as many less one holds a whole block.
BLOCK = 24
_POWERS = [np.ones(1, np.int64), np.ones(1, np.int64)]


def _powers(k: int, n: int) -> np.ndarray:
    """BASES[k]**i modulo PRIMES[k] for i < n, by doubling."""
    have = _POWERS[k]
    while len(have) < n:
        step = pow(BASES[k], len(have), PRIMES[k])
        have = np.concatenate((have, have * step % PRIMES[k]))
    _POWERS[k] = have
    return have[:n]


class Prefixes:
    def __init__(self, chars: np.ndarray):
        """``chars``: code points."""
        self.n = len(chars)
        self.sums = []
        for k, prime in enumerate(PRIMES):
            sums = np.zeros(self.n + 1, np.int64)
            # terms are below 2**31, so 2**32 of them fit in 63 bits
            np.cumsum((chars + 1) * _powers(k, self.n) % prime, out=sums[1:])
            self.sums.append(sums % prime)

    def same(self, start: int, other: Prefixes, at: int, length: int) -> bool:
        """Whether this text from ``start`` and the other from ``at`` agree on ``length`` characters."""
        for k, prime in enumerate(PRIMES):
            mine = int(self.sums[k][start + length] - self.sums[k][start]) % prime
            theirs = int(other.sums[k][at + length] - other.sums[k][at]) % prime
            power = _POWERS[k]
            if mine * int(power[at]) % prime != theirs * int(power[start]) % prime:
                return False
        return True

    def extension(self, other: Prefixes, most: int, ends: bool = False) -> int:
        """Longest common start (or end) of the two texts, up to ``most``."""
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(self.n - mid if ends else 0, other, other.n - mid if ends else 0, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def fingerprint(self) -> str:
        return f"{self.n:x}.{int(self.sums[0][-1]):08x}{int(self.sums[1][-1]):08x}"

    def likeness(self, other: Prefixes) -> float:
        """Share of the longer text in a common start and end that don't overlap; 1 for equal texts."""
        most, longest = min(self.n, other.n), max(self.n, other.n)
        if longest == 0:
            return 1.0
        for k in range(len(PRIMES)):
            _powers(k, longest + 1)
        head = self.extension(other, most)
        return (head + self.extension(other, most - head, ends=True)) / longest

    def common(self, start: int, other: Prefixes, at: int, most: int, back: bool = False) -> int:
        """Characters, up to ``most``, that agree from ``start`` and ``at`` on (or before them)."""
        low, high = 0, most
        while low < high:
            mid = (low + high + 1) // 2
            if self.same(start - mid if back else start, other, at - mid if back else at, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def names(self, start: np.ndarray, length: int, longest: int) -> np.ndarray:
        """Span hashes that don't depend on the place (``longest``: of all texts compared)."""
        one, two = ((self.sums[k][start + length] - self.sums[k][start]) % prime * _POWERS[k][longest - start] % prime
                    for k, prime in enumerate(PRIMES))
        return one << 31 | two

    def share(self, other: Prefixes) -> float:
        """Share of the longer text in common spans that overlap in neither text: the
        common start and end, and between them, from left to right, spans around
        each block of the other text that is found; 1 for equal texts."""
        most, longest = min(self.n, other.n), max(self.n, other.n)
        if longest == 0:
            return 1.0
        for k in range(len(PRIMES)):
            _powers(k, longest + 1)
        head = self.extension(other, most)
        tail = self.extension(other, most - head, ends=True)
        covered = head + tail
        if most - covered < BLOCK:
            return covered / longest
        pos, stop = head, self.n - tail
        blocks = np.arange(head, other.n - tail - BLOCK + 1, BLOCK)
        named = other.names(blocks, BLOCK, longest)
        order = np.argsort(named, kind="stable")
        blocks, named = blocks[order], named[order]
        mine = self.names(np.arange(pos, stop - BLOCK + 1), BLOCK, longest)
        first = np.searchsorted(named, mine)
        hits = np.flatnonzero(named[np.minimum(first, len(named) - 1)] == mine)
        first, last = first[hits], np.searchsorted(named, mine[hits], "right")
        hits, i, after = hits + pos, 0, head
        # spans of the other text that are taken, by start; a block below ``low`` of its name is
        begins, ends, low = [0, other.n - tail], [head, other.n], {}

        def open_block(a: int, b: int) -> int:
            """The first free block of these equal ones after the last span, else the first free one."""
            for c in (int(np.searchsorted(blocks[a:b], after)) + a, low.get(a, a)):
                while c < b:
                    at = int(blocks[c])
                    j = bisect(begins, at)
                    if ends[j - 1] <= at and begins[j] >= at + BLOCK:
                        return c
                    if c == low.get(a, a):
                        low[a] = c + 1
                    elif c > low.get(a, a):
                        break
                    c += 1
            return -1
        while i < len(hits):
            p = int(hits[i])
            if p < pos:
                i = int(np.searchsorted(hits, pos))
                continue
            c = open_block(int(first[i]), int(last[i]))
            i += 1
            if c < 0:
                continue
            at = int(blocks[c])
            j = bisect(begins, at)
            left = self.common(p, other, at, min(p - pos, at - ends[j - 1]), back=True)
            right = self.common(p, other, at, min(stop - p, begins[j] - at))
            begins.insert(j, at - left)
            ends.insert(j, at + right)
            covered += left + right
            pos, after = p + right, at + right
        return covered / longest


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


class Fingerprint:
    def __init__(self, text: str):
        self.text = text
        self.prefixes = Prefixes(_chars(text))


def edited(text: str, following: str) -> str:
    """The last half of ``text`` replaced by the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _walk(batches, like=Prefixes.likeness):
    """Rows of a chunk come in order, its last one followed by a row with ``mark``
    that holds the next chunk's first text."""
    held = None
    for batch in parts(batches):
        rows = []
        for doc, text, mark in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                   batch.column("mark").to_pylist(), strict=True):
            here = Fingerprint(text or "")
            if held is not None:
                doc_was, was = held
                new = edited(was.text, here.text)
                after = Prefixes(_chars(new))
                rows.append((doc_was, was.prefixes.n, hashlib.sha256(new.encode()).hexdigest(),
                             was.prefixes.fingerprint(), after.fingerprint(), like(was.prefixes, after),
                             like(was.prefixes, here.prefixes)))
            held = None if mark else (doc, here)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        cols = list(zip(*rows, strict=True)) if rows else [()] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                         names=[x.split()[0] for x in _OUT.split(", ")])


def _walk_spans(batches):
    return _walk(batches, Prefixes.share)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          spans: bool = False) -> DataFrame:
    """Per row ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``.

    The next document is the one after it by falling id, then (equal ids) by
    falling text, null ids and texts last; after the last comes the first, so a
    single document follows itself.  Null text is empty text; two empty texts
    have likeness 1.  Other columns are ignored.  No rows: an empty table.
    ``spans``: near_edited and near_next count all common spans, not only the
    common start and end.

    Ids are cut into chunks at quantiles; a chunk's first text is handed to the
    chunk before it, so the texts move once and each chunk streams through a
    task with one row in hand."""
    rows = ready(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    count = rows.count()
    parts = min(max(1, count // CHUNK_ROWS), MOST_CHUNKS)
    cuts = []
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        cuts = sorted({int(c) for c in rows.approxQuantile("doc_id", at, 1 / (4 * parts))})
    wide = max(1, int(len(cuts) ** 0.5))
    # ids above a cut, counted in two steps: every wide-th cut first, then those between
    if cuts:
        coarse = F.size(F.filter(F.lit(cuts[wide - 1::wide]).cast("array<long>"), lambda c: c < F.col("doc_id")))
        some = F.slice(F.lit(cuts).cast("array<long>"), coarse * wide + 1, wide)
        chunk = coarse * wide + F.size(F.filter(some, lambda c: c < F.col("doc_id")))
    else:
        chunk = F.lit(0)
    rows = rows.withColumn("chunk", F.when(F.col("doc_id").isNull(), -1).otherwise(chunk).cast("int"))
    tops = sorted((r["chunk"], r["top"]) for r in rows.groupBy("chunk").agg(F.max("doc_id").alias("top")).collect())
    spark = docs.sparkSession
    # at most MOST_CHUNKS + 1 rows
    heads = spark.createDataFrame([(tops[i][0], tops[i - 1][1]) for i in range(len(tops))], "chunk int, top long")
    first = (rows.select("doc_id", "text").join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("top")))
             .groupBy("chunk").agg(F.max("text").alias("text")))
    marks = first.select(F.lit(None).cast("long").alias("doc_id"), "text", "chunk", F.lit(True).alias("mark"))
    every = rows.withColumn("mark", F.lit(False)).unionByName(marks)
    ordered = every.repartition("chunk").sortWithinPartitions(
        "chunk", "mark", F.desc_nulls_last("doc_id"), F.desc_nulls_last("text"))
    return ordered.select("doc_id", "text", "mark").mapInArrow(_walk_spans if spans else _walk, _OUT)
