"""Embedding whitening by Chebyshev-filtered subspace iteration.

The covariance V of the vectors is never formed.  A block Q of a few more
columns than components wanted is multiplied by V in one distributed pass:
every task centres its vectors (x - S/n, from the exact integer n*x - S), adds
up X'(XQ) for its rows, and Spark sums those small matrices.  A round of the
iteration is

1. Rayleigh-Ritz: with Q orthonormal and VQ at hand, the eigenvectors of Q'VQ
   turn Q into Ritz vectors; their residuals |Vq - eq| need no further pass;
2. if all wanted residuals are below the tolerance, the components are
   certified and the iteration ends;
3. else a Chebyshev polynomial in V, by its three-term recurrence (one pass per
   degree), damps the part of the spectrum between 0, a sure bound as V has no
   negative eigenvalue, and the least Ritz value of the block, and QR makes the
   block orthonormal again.

The degree is chosen so that the largest component does not outgrow the
least wanted one by more than ``SPREAD`` in one round.  Where the spectrum is so
flat that convergence would take more than ``PASSES`` passes, the block is
widened, at last to the whole space, where the first step alone is exact; so the
iteration always ends.  The driver holds matrices of dimension times block only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.frames import materialize, ready

SCALE, OFFSET = 64, 1_000_000
#: Extra columns of a block, residual that certifies (relative to the largest eigenvalue).
EXTRA, TOLERANCE = 16, 1e-13
SPREAD, PASSES = 1e10, 150
WIDE = "decimal(38,0)"


def _finite(x):
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def integral(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: the vectors whose entries are all finite, entry c as floor(64 * c) + 1000000.

    A null id stays; other columns are ignored.  Of vectors of different length
    the shorter ones go on with entries of 0.  Entries beyond 2**50 in size are an error."""
    ok = F.col(vec_col).isNotNull() & F.coalesce(F.forall(vec_col, _finite), F.lit(False))
    x = F.transform(vec_col, lambda c: F.floor(F.lit(SCALE) * c.cast("double")) + F.lit(OFFSET))
    kept = rows.filter(ok).select(F.col(id_col).alias("vec_id"), x.alias("x"))
    kept = materialize(ready(kept), "vectors")
    low, d = kept.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if low != d:
        rest = F.array_repeat(F.lit(OFFSET).cast("long"), F.lit(d) - F.size("x"))
        kept = materialize(kept.select("vec_id", F.concat("x", rest).alias("x")), "vectors")
    return kept


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def _sums(d: int):
    """Per task and dimension: rows, sum and sum of squares of x - OFFSET, exact."""
    def run(batches):
        n, s, q = 0, [0] * d, [0] * d
        for batch in batches:
            y = _matrix(batch.column("x")) - OFFSET
            if not len(y):
                continue
            big = float(np.abs(y).max()) ** 2 * len(y) > 2 ** 62
            y = y.astype(object) if big else y
            n, s, q = n + len(y), [a + int(b) for a, b in zip(s, y.sum(axis=0), strict=True)], [
                a + int(b) for a, b in zip(q, (y * y).sum(axis=0), strict=True)]
        if n:
            text = lambda v: pa.array([str(a) for a in v])
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()), text(s), text(q)],
                                             names=["i", "n", "s", "q"])
    return run


@dataclass
class Whitening:
    """Exact moments and the certified components (rows of ``axes``) of a table of vectors."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    axes: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    residual: float = 0.0
    passes: int = 0
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from n*x - S, which is exact."""
        return (self.n * x - np.array(self.sums, np.int64)) / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.axes / np.sqrt(self.values)[:, None]).T


def _partial(make, wide: int):
    """The sum over a task's rows of a small matrix, row by row with its number."""
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = make(_matrix(batch.column("x")))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), *(pa.array(total[:, j]) for j in range(wide))],
                names=["i", *(f"c{j}" for j in range(wide))])
    return run


def _summed(x: DataFrame, make, wide: int) -> np.ndarray:
    """The sum over all rows of the matrices that ``make`` gives for blocks of rows."""
    cols = [f"c{j}" for j in range(wide)]
    parts = x.select("x").mapInArrow(_partial(make, wide), ", ".join(["i int", *(f"{c} double" for c in cols)]))
    rows = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in cols]).collect()
    return np.array([r[1:] for r in sorted(rows)], np.float64)


def _moments(x: DataFrame) -> Whitening:
    d = x.agg(F.max(F.size("x"))).first()[0] or 0
    if not d:
        return Whitening(0, [], 0.0)
    rows = x.select("x").mapInArrow(_sums(d), "i int, n long, s string, q string").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast(WIDE)).alias("s"), F.sum(F.col("q").cast(WIDE)).alias("q"))
    rows = sorted(rows.collect())
    n, s, q = rows[0]["n"], [int(r["s"]) for r in rows], [int(r["q"]) for r in rows]
    return Whitening(n, [a + n * OFFSET for a in s], sum(n * b - a * a for a, b in zip(s, q, strict=True)) / n ** 3 * n)


def _growth(value: float, cut: float) -> float:
    """Growth per degree of a Chebyshev polynomial on [0, cut] at ``value``."""
    t = max(2 * value / cut - 1, 1.0)
    return t + np.sqrt(t * t - 1)


def fit(x: DataFrame, k: int = 32, seed: int = 7, tolerance: float = TOLERANCE) -> Whitening:
    """Moments and the ``min(k, dimension)`` first components of ``x`` (``integral``).

    Directions whose eigenvalue is 0 (at most 1e-14 of the largest: one row, equal
    rows, constant entries) are no components and left out."""
    out = _moments(x)
    d, k = len(out.sums), min(k, len(out.sums))
    if not d or not out.trace:
        return out
    rng = np.random.Generator(np.random.PCG64(seed))
    passes = 0

    def times(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        centred = out.centred

        def part(rows):
            z = centred(rows)
            return z.T @ (z @ q)
        return _summed(x, part, q.shape[1]) / out.n

    b, q, best, stale = min(d, k + EXTRA), None, np.inf, 0
    q = np.linalg.qr(rng.standard_normal((d, b)))[0]
    vq = times(q)
    while True:
        h = q.T @ vq
        value, turn = np.linalg.eigh((h + h.T) / 2)
        value, turn = value[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        out.residual = float(np.linalg.norm(vq[:, :k] - q[:, :k] * value[:k], axis=0).max() / value[0])
        stale = 0 if out.residual < best / 2 else stale + 1
        best = min(best, out.residual)
        # rounding bounds what any pass can give: no progress any more, at a residual far below the gaps' order
        if out.residual <= tolerance or b == d or (stale > 2 and out.residual <= 100 * tolerance):
            break
        cut = max(value[-1], 1e-14 * value[0])
        slow, fast = _growth(value[k - 1], cut), _growth(value[0], cut)
        need = np.log(max(out.residual / tolerance, 2)) / max(np.log(slow), 1e-9)
        if (need > PASSES and passes > 2 * EXTRA) or stale > 4:
            b = min(d, 2 * b)
            q = np.linalg.qr(np.hstack([q, rng.standard_normal((d, b - q.shape[1]))]))[0]
            vq, best, stale = times(q), np.inf, 0
            continue
        room = np.log(SPREAD) / max(np.log(fast / slow), 1e-9)
        degree = int(np.clip(min(need + 1, room), 2, 24))
        half = cut / 2
        old, new = q, (vq - half * q) / half
        for _ in range(degree - 1):
            old, new = new, 2 * (times(new) - half * new) / half - old
            size = np.linalg.norm(new, axis=0)
            old, new = old / size, new / size
        q = np.linalg.qr(new)[0]
        vq = times(q)
    real = value[:k] > 1e-14 * value[0]
    out.values, out.axes, out.passes = value[:k][real], np.ascontiguousarray(q[:, :k][:, real].T), passes
    out.identity_error = _identity_error(x, out)
    return out


def _identity_error(x: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    k = len(model.values)
    mean = _summed(x, lambda rows: model.whiten(rows).sum(axis=0)[None, :], k)[0] / model.n

    def part(rows):
        w = model.whiten(rows) - mean
        return w.T @ w
    return float(np.abs(_summed(x, part, k) / model.n - np.eye(k)).max())


def _projected(model: Whitening):
    n = model.n
    centre = [(2 * s + n) // (2 * n) for s in model.sums]
    rest = np.array([s - n * c for s, c in zip(model.sums, centre, strict=True)], np.int64)
    centre = np.array(centre, np.int64)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                x = _matrix(part.column("x"))
                y, w = x - centre, model.whiten(x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array((y * y).sum(axis=1)), pa.array(y @ rest),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(w.ravel()))],
                    names=["vec_id", "squares", "cross", "w"])
    return run


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row for each vector and component.

    deviation, decimal(38,0), is exact: with x = c + y and S = n*c + t the sum of
    (n*x - S)**2 is n**2 * sum(y*y) - 2*n * sum(y*t) + sum(t*t).  No vectors, or
    vectors that are all equal: an empty table."""
    schema = "vec_id long, squares long, cross long, w array<double>"
    if not len(model.values):
        rows = x.select("vec_id", F.lit(0).cast("long").alias("squares"), F.lit(0).cast("long").alias("cross"),
                        F.array().cast("array<double>").alias("w")).filter("false")
    else:
        rows = x.mapInArrow(_projected(model), schema)
    n, k = model.n, len(model.values)
    rest = [s - n * ((2 * s + n) // (2 * n)) for s in model.sums] if n else []
    big = lambda v: F.lit(str(v)).cast(WIDE)
    deviation = (big(n * n) * F.col("squares").cast("decimal(19,0)") - big(2 * n) * F.col("cross").cast("decimal(19,0)")
                 + big(sum(t * t for t in rest))).cast(WIDE)
    share = F.array(*[F.lit(float(v / model.trace)) for v in model.values]) if k else F.array().cast("array<double>")
    rows = rows.select("vec_id", deviation.alias("deviation"), F.posexplode("w").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                       F.element_at(share, F.col("at") + 1).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))


def whiten(rows: DataFrame, k: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Whitened vectors of a table: ``integral``, ``fit`` and ``transform`` in one."""
    x = integral(rows, id_col, vec_col)
    return transform(x, fit(x, k))
