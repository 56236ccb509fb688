"""Joins Spark has no single operator for: time-band (interval) join and as-of join.

Both are built from equi-joins and windows so they shuffle on keys and never
form all pairs of a key:

* ``band_join``: rows of ``right`` whose time lies in
  ``[left_t + lower, left_t + upper]``.  Time is cut into buckets of the
  band's width; each left row is copied to the (few) buckets its band
  touches, and the equi-join on (keys, bucket) is followed by the exact band
  filter.  Pairs are bounded by the band, not by the key's size.
* ``asof_join``: for each left row, the newest right row of the same key with
  ``right_t <= left_t``.  Done by a union of both sides and a running
  ``last(..., ignorenulls)`` inside (key, time chunk) partitions, with the
  newest right row of earlier chunks carried in from a small per-chunk
  table — no pairs, and a hot key is split over its chunks.

``windows.top1_per_group`` and the ``running`` module follow the same rule:
partial aggregates before every shuffle, and per-key sequences computed per
(key, chunk) rather than per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros, epoch_millis
from riverbed.operators.running import join_back, volume_chunk


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str, right_t: str,
              lower_ms: int, upper_ms: int, how: str = "inner", left_id: str | None = None) -> DataFrame:
    """Equi-join on ``keys`` plus ``left_t + lower <= right_t <= left_t + upper``.

    ``how`` is ``inner``, ``left_semi`` or ``left_anti``; column names of the two
    sides must not clash except for ``keys``.
    """
    width = max(upper_ms - lower_ms, 1)
    lo = F.floor((epoch_millis(left_t) + lower_ms) / width)
    hi = F.floor((epoch_millis(left_t) + upper_ms) / width)
    lb = left.withColumn("_bucket", F.explode(F.sequence(lo, hi)))
    rb = right.withColumn("_bucket", F.floor(epoch_millis(right_t) / width))
    delta = F.timestamp_diff("MILLISECOND", F.col(left_t), F.col(right_t))
    cond = [lb[k] == rb[k] for k in keys] + [lb["_bucket"] == rb["_bucket"],
                                              delta.between(lower_ms, upper_ms)]
    if how == "inner":
        j = lb.join(rb, on=cond, how="inner")
        return j.drop(lb["_bucket"]).drop(rb["_bucket"]).drop(*[rb[k] for k in keys])
    if how in ("left_semi", "left_anti"):
        # a left row copied into two buckets may match in either: decide per copy,
        # then per row through its unique id
        if left_id is None:
            raise ValueError("semi/anti band joins need left_id")
        matched = lb.join(rb, on=cond, how="left_semi").select(left_id).distinct()
        return left.join(matched, on=left_id, how=how)
    raise ValueError(how)


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str, right_t: str,
              carry: Sequence[str], chunk_fn=None, how: str = "left") -> DataFrame:
    """Left-outer as-of join: each left row gets ``carry`` columns of the newest
    right row with the same keys and ``right_t <= left_t`` (nulls if none), and
    that row's time as ``matched_at``.  A right row at the same instant as a
    left row counts as earlier; among right rows at one instant the last in
    ``carry`` order wins.

    ``how="inner"`` drops left rows with no match.  ``chunk_fn`` maps the time
    column to a monotone chunk (default: ranges cut by volume, see ``volume_chunk``).

    Skew-safe: time is cut into chunks; per (key, chunk) the
    newest right row is found by a partial aggregate, carried across chunks by
    a window over the small (key, chunk) table, and inside a chunk by a
    running ``last(ignorenulls)``.  A hot key is thus spread over its chunks.
    """
    keys = list(keys)
    lcols = list(left.columns)
    # a null key or time matches nothing; left rows that have one stay, unmatched
    for c in [*keys, right_t]:
        right = right.filter(F.col(c).isNotNull())
    rstruct = F.struct(F.col(right_t).alias("matched_at"), *[F.col(c) for c in carry])
    l_ = left.select(*lcols, F.col(left_t).alias("_t"), F.lit(1).alias("_side"),
                     F.lit(None).cast(right.select(rstruct.alias("r")).schema["r"].dataType).alias("_r"))
    r_ = right.select(*[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in lcols if c not in keys],
                      *keys, F.col(right_t).alias("_t"), F.lit(0).alias("_side"), rstruct.alias("_r"))
    u = l_.unionByName(r_)
    if chunk_fn is None:
        timed = dict(u.dtypes)["_t"].startswith(("timestamp", "date"))
        chunk = volume_chunk(u, epoch_micros("_t") if timed else F.col("_t"))
    else:
        chunk = chunk_fn(F.col("_t"))
    u = u.withColumn("_chunk", chunk)
    newest = u.groupBy(*keys, "_chunk").agg(F.max_by("_r", F.when(F.col("_side") == 0, F.struct("_t", "_r"))).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry_in = newest.select(*keys, "_chunk", F.last("_last", ignorenulls=True).over(before).alias("_in"))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_t", "_side", "_r").rowsBetween(Window.unboundedPreceding, 0)
    filled = (u.withColumn("_within", F.last("_r", ignorenulls=True).over(w))
              .filter(F.col("_side") == 1))
    filled = join_back(filled, carry_in, [*keys, "_chunk"]).withColumn("_m", F.coalesce("_within", "_in"))
    if how == "inner":
        filled = filled.filter(F.col("_m").isNotNull())
    return filled.select(*lcols, *[F.col("_m")[c].alias(c) for c in carry], F.col("_m")["matched_at"].alias("matched_at"))
