"""Token-id output: documents packed into fixed-length rows, best fit decreasing.

A task encodes its documents in order and collects token segments up to
``pool`` tokens; each such pool is packed on its own, so memory is bounded by
the pool and nothing is shuffled.  Documents longer than a row are split into
full rows and a rest, losslessly.  Segments of a pool go in falling length,
each into the open row with the least room that still holds it; a segment tree
over room sizes finds that row in logarithmic time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.bpe import load_ranks
from riverbed.llm.frames import ready


class RoomTree:
    """Open rows by free room; ``fit(need)`` finds the least room >= need."""

    def __init__(self, length: int):
        self.leaves = 1
        while self.leaves <= length:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, room: int, by: int) -> None:
        i = self.leaves + room
        while i:
            self.count[i] += by
            i //= 2

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def fit(self, need: int) -> tuple[int, int] | None:
        """Take the open row with the least sufficient room: (room, row)."""
        i = self.leaves + need
        if not self.count[i]:
            while i > 1 and (i % 2 or not self.count[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of segment numbers; sizes are 1..length."""
    tree, rows = RoomTree(length), []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        got = tree.fit(sizes[i])
        if got is None:
            rows.append([i])
            room = length - sizes[i]
        else:
            rows[got[1]].append(i)
            room = got[0] - sizes[i]
        tree.put(room, len(rows) - 1 if got is None else got[1])
    return rows


class _Pool:
    def __init__(self, length: int, pad: int):
        self.length, self.pad, self.tokens = length, pad, 0
        self.parts: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        self.tokens += len(ids)
        for at in range(0, len(ids), self.length):
            self.parts.append((doc, at, ids[at:at + self.length]))

    def rows(self) -> pa.RecordBatch:
        packed = best_fit([len(p[2]) for p in self.parts], self.length)
        ids = np.full((len(packed), self.length), self.pad, "<u2")
        reset = np.zeros((len(packed), self.length), "<u2")
        sums, docs, froms = [], [], []
        for r, members in enumerate(packed):
            at, cut = 0, [0]
            for m in members:
                n = len(self.parts[m][2])
                ids[r, at:at + n] = self.parts[m][2]
                reset[r, at:at + n] = np.arange(n)
                at += n
                cut.append(at)
            reset[r, at:] = np.arange(self.length - at)
            sums.append(cut)
            docs.append([self.parts[m][0] for m in members])
            froms.append([self.parts[m][1] for m in members])
        self.parts, self.tokens = [], 0
        return pa.RecordBatch.from_arrays(
            [pa.array([c[-1] for c in sums], pa.int32()), pa.array([x.tobytes() for x in ids], pa.binary()),
             pa.array(sums, pa.list_(pa.int32())), pa.array([x.tobytes() for x in reset], pa.binary()),
             pa.array(docs, pa.list_(pa.int64())), pa.array(froms, pa.list_(pa.int32()))],
            names=["n_tokens", "ids", "cu_seqlens", "positions", "doc_ids", "doc_offsets"])


def _pack(ranks, pattern: str, length: int, pad: int, tokens: int):
    def run(batches):
        coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        pool = _Pool(length, pad)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                pool.add(doc, np.array(coder.encode_ordinary(text.as_py() or ""), "<u2"))
                if pool.tokens >= tokens:
                    yield pool.rows()
        if pool.parts:
            yield pool.rows()
    return run


def pack_tokens(docs: DataFrame, vocabulary: str, pattern: str, length: int = 2048, pad: int = 50256,
                pool: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per packed sequence of ``length`` ids: ``n_tokens`` in use, ``ids``
    and ``positions`` (``length`` little-endian uint16 each; positions start at 0
    with every segment and with the padding), ``cu_seqlens`` (cumulative segment
    lengths from 0), ``doc_ids`` and ``doc_offsets`` (where a segment comes from).

    Every token of every text is in exactly one row.  Null and empty texts give
    no segment; repeated rows are packed each; null ids are kept as null; other
    columns are ignored; no rows give an empty table.  Ids must be below 65,536
    and ``length`` at most 65,535.  Which texts share a pool depends on how the
    input is split into tasks."""
    ranks = load_ranks(vocabulary)
    if max(ranks.values(), default=0) > 0xFFFF or not 0 < length <= 0xFFFF:
        raise ValueError("ids and positions must fit in 16 bits")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    return ready(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _pack(shared, pattern, length, pad, pool),
        "n_tokens int, ids binary, cu_seqlens array<int>, positions binary, doc_ids array<long>, "
        "doc_offsets array<int>")


def write_matrices(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; a file's ids column is its id matrix, row by row."""
    packed.write.mode("error").parquet(path)
