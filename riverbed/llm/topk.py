"""Exact top-k inner-product search on an impact-ordered index, score at a time.

A posting is one component of one vector; its quantised impact is the bit
length of its magnitude.  A block of vectors keeps its postings in segments of
equal impact, highest first.  A block of queries takes the segments in that
order and adds each one's share to the accumulators.  After a segment, the
components not yet seen of vector i have length ``rest[i]``, so every score
lies within ``|q| * rest[i]`` of its accumulator.  Vectors whose upper bound is
below the query's k-th best score so far can't be members; when few are left, or
no segment is, the rest are scored exactly from the whole vectors.  There is no
other stop.  The segments of highest impact, without which no bound is tight,
are added in one product, with the bound.

Spark deals the vectors to cells of bounded volume, each vector to one, and sends
every query once to each cell.  A task indexes its cell block by block, then takes
the queries as they come, a block at a time through all blocks of the cell, and
raises each query's k-th best score on the way.  It holds a cell and a block of
queries, whatever the size of the tables; k rows per query and cell go to one
last ranking.  Neither side is collected or broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.frames import materialize, ready

#: Vectors and queries in a block.
BLOCK, QUERY_BLOCK = 4096, 256
#: Components of the vectors of a cell (a cell has a block of vectors at least).
CELL = 1 << 24


def _matrix(col: pa.ListArray) -> np.ndarray:
    """Rows of different length are filled up with zeros."""
    size = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False)
    width = max(int(size.max(initial=0)), 1)
    if len(flat) == len(size) * width:
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), flat.dtype)
    out[np.repeat(np.arange(len(size)), size),
        np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _true(flags: np.ndarray) -> np.ndarray:
    """Places of the few true flags, looked for eight at a time."""
    whole = len(flags) // 8 * 8
    at = (8 * np.flatnonzero(flags[:whole].view(np.uint64))[:, None] + np.arange(8)).ravel()
    return np.concatenate((at[flags[at]], whole + np.flatnonzero(flags[whole:])))


class ImpactIndex:
    """A block of integer vectors, its postings in segments of falling impact.

    ``first`` holds the first segments as one, with ``rest`` as a last column;
    ``later`` names the others by impact, with what each takes off ``rest``.
    Products are in 32 bits; ``rest`` is longer by more than they can be wrong."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        v = vectors.astype(np.float64)
        impact, square = np.frexp(np.abs(v))[1], v ** 2
        length = square.sum(axis=1)
        self.longest = np.sqrt(length.max(initial=0))
        wrong = np.sqrt(length) * (v.shape[1] + 64) * 2.0 ** -20
        self.first, self.later, before = None, [], None
        for level in np.flatnonzero(np.bincount(impact[v != 0], minlength=1))[::-1]:
            unseen = np.where(impact < level, square, 0).sum(axis=1)
            rest = np.sqrt(unseen)
            if self.first is not None:
                self.later.append((level, rest - before))
            elif unseen.sum() <= length.sum() / 64:
                self.first = self._with(np.where(impact >= level, v, 0), rest + wrong)
            before = rest
        if self.first is None:
            self.first = self._with(v, wrong)

    @staticmethod
    def _with(part: np.ndarray, rest: np.ndarray) -> np.ndarray:
        return np.concatenate((part, rest[:, None]), axis=1, dtype=np.float32, casting="same_kind")

    def _later(self, level: int, off: np.ndarray) -> np.ndarray:
        size = np.abs(self.vectors.astype(np.float64))
        return self._with(np.where((size >= 2.0 ** (level - 1)) & (size < 2.0 ** level), self.vectors, 0.0), off)

    def _least(self, q: np.ndarray, k: int, own: np.ndarray | None) -> np.ndarray:
        """Of each query the k-th best score in the first rows of the block."""
        n = min(len(self.vectors), max(4 * k, 1024))
        if n < k:
            return np.full(len(q), -np.inf)
        score = q @ self.vectors[:n].astype(np.float64).T
        if own is not None:
            score[own[:, :n]] = -np.inf
        wrong = np.sqrt((q ** 2).sum(axis=1)) * self.longest * (q.shape[1] + 8) * 2.0 ** -50
        return np.partition(score, n - k, axis=1)[:, n - k] - wrong

    def search(self, queries: np.ndarray, k: int, own: np.ndarray | None = None,
               least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query rows, vector rows and exact scores of all possible members of
        each query's top k; ``own`` marks (query, vector) pairs left out.
        ``least``: scores that k others of each query are known to reach."""
        nq, nv = len(queries), len(self.vectors)
        q = queries.astype(np.float64)
        if least is None:
            least = self._least(q, k, own)
        low = np.nextafter(least.astype(np.float32), np.float32(-np.inf))[:, None]
        with_length = self._with(q, np.sqrt((q ** 2).sum(axis=1)) * (1 + 1e-6))
        most = with_length @ self.first.T
        found = _true((most >= low).ravel())
        for segment in self.later:
            # a pair scored alone costs as much as some 32 in a product
            if len(found) <= max(8 * k * nq, nq * nv // 32):
                break
            most += with_length @ self._later(*segment).T
            found = _true((most >= low).ravel())
        if own is not None:
            found = found[~own.ravel()[found]]
        at, who = np.divmod(found, nv)
        score = np.empty(len(at), np.int64)
        for j in range(0, len(at), 1 << 16):
            s = slice(j, j + (1 << 16))
            score[s] = np.einsum("ij,ij->i", queries[at[s]], self.vectors[who[s]], dtype=np.int64)
        return at, who, score


def _ask(blocks: list, key: np.ndarray, qid: np.ndarray, asked: np.ndarray, k: int) -> pa.RecordBatch:
    """The k best rows of a cell for each of some queries."""
    at, vid, score, least = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), None
    for ids, index in blocks:
        # components that no vector of the block has add nothing to a score
        width = index.vectors.shape[1]
        q = asked[:, :width]
        q = np.pad(q, ((0, 0), (0, width - q.shape[1])))
        own = qid[:, None] == ids[None, :] if least is None else None
        a, who, s = index.search(q, k, own, least)
        other = qid[a] != ids[who]
        if least is not None and not other.any():
            continue
        at, vid, score = (np.concatenate(x) for x in ((at, a[other]), (vid, ids[who[other]]), (score, s[other])))
        order = np.lexsort((vid, -score, at))
        at, vid, score = at[order], vid[order], score[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        least = np.full(len(qid), -np.inf)
        least[at[rank == k - 1]] = score[rank == k - 1]
        top = rank < k
        at, vid, score = at[top], vid[top], score[top]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (key[at], qid[at], vid, score)],
                                      names=["qkey", "query_id", "vec_id", "score"])


def _search(k: int, block: int, query_block: int):
    def indexed(held):
        return (np.concatenate([ids.to_numpy() for ids, _ in held]),
                ImpactIndex(_matrix(pa.concat_arrays([vectors for _, vectors in held]))))

    def run(batches):
        cell, blocks, held, n = None, [], [], 0
        for batch in batches:
            cells, asks = batch.column("cell").to_numpy(), batch.column("asks").to_numpy()
            key, ids, vectors = (batch.column(c) for c in ("qkey", "id", "vec"))
            cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(asks) != 0)) + 1
            for i, end in zip((0, *cuts), (*cuts, batch.num_rows), strict=True):
                if i < end and cells[i] != cell:
                    cell, blocks, held, n = cells[i], [], [], 0
                while i < end and not asks[i]:
                    some = min(block - n, end - i)
                    held.append((ids.slice(i, some), vectors.slice(i, some)))
                    i, n = i + some, n + some
                    if n == block:
                        blocks.append(indexed(held))
                        held, n = [], 0
                if i < end and held:
                    blocks.append(indexed(held))
                    held, n = [], 0
                for j in range(i, end, query_block):
                    some = min(query_block, end - j)
                    yield _ask(blocks, key.slice(j, some).to_numpy(), ids.slice(j, some).to_numpy(),
                               _matrix(vectors.slice(j, some)), k)
    return run


def _finite(x):
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def quantised(rows: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, vec`` with components floor(scale * x); rows without an id, and
    vectors that are null or hold a null or non-finite component, are left out."""
    ok = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(vec_col, _finite)
    return rows.filter(ok).select(
        F.col(id_col).alias("vec_id"),
        F.transform(vec_col, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("vec"))


def _extent(rows: DataFrame) -> tuple[int, int, int]:
    """Number of rows, most components of a row (1 at least), largest magnitude."""
    n, wide, low, high = rows.agg(F.count(F.lit(1)), F.max(F.size("vec")), F.min(F.array_min("vec")),
                                  F.max(F.array_max("vec"))).first()
    return n, max(wide or 0, 1), max(high or 0, -(low or 0))


def _kind(size: int) -> str:
    """The type of an array that holds integers of this magnitude."""
    return f"array<{'smallint' if size < 1 << 15 else 'int' if size < 1 << 31 else 'bigint'}>"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k vectors (all, if
    fewer) with the highest inner product, ties to the smaller id.

    Both inputs are ``vec_id, vec`` with integer vectors.  A query never meets
    rows of its own id.  Queries equal in id and vector are one query; other
    repeated rows count one by one.  Vectors of different length are compared as
    if the shorter one went on with zeros; an empty vector scores 0.  Scores
    must fit in 53 bits.  No queries or no vectors: an empty table."""
    vectors = materialize(ready(vectors), "vectors")
    asked = queries.dropDuplicates(["vec_id", "vec"]).withColumn("qkey", F.xxhash64("vec_id", "vec"))
    asked = materialize(asked, "queries")
    rows, wide, size = _extent(vectors)
    kind = _kind(max(size, _extent(asked)[2]))
    cells = max(1, -(-rows // max(BLOCK, CELL // wide)),
                min(-(-rows // BLOCK), 4 * vectors.sparkSession.sparkContext.defaultParallelism))
    columns = F.col("vec_id").cast("long").alias("id"), F.col("vec").cast(kind).alias("vec")
    # by place in the written table, so that many equal rows spread like any others
    cell = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(cells)).cast("int")
    v = vectors.select(cell.alias("cell"), F.lit(0).alias("asks"), F.lit(0).cast("long").alias("qkey"), *columns)
    q = asked.select(F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), F.lit(1).alias("asks"), "qkey",
                     *columns)
    best = (v.unionAll(q).repartitionById(cells, "cell").sortWithinPartitions("cell", "asks")
            .mapInArrow(_search(k, BLOCK, QUERY_BLOCK), "qkey long, query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id", "qkey").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
