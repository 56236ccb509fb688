"""Running (prefix) aggregates that survive hot keys.

A plain ``sum().over(partitionBy(key).orderBy(t))`` sends every row of a key to
one task.  When one key may hold a third of the table that task becomes the
whole job, and a global running count (no key at all) is a single-partition
window.  ``running_sum`` splits each key's order into chunks (a monotone
bucket of the ordering; ``volume_chunk`` cuts it so that chunks hold alike
many rows, whatever the key and however bursty the times), so:

1. per (key, chunk) totals — a partial aggregate, tiny output;
2. per key, an exclusive prefix over the chunk totals — a window over
   (#keys × #chunks) rows, not over the detail;
3. per (key, chunk) running sums over the detail, plus the chunk offset.

Step 3 is partitioned by (key, chunk), so a hot key is spread over as many
tasks as it has chunks; the offset join reuses that partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros


def join_back(detail: DataFrame, small: DataFrame, on: Sequence[str]) -> DataFrame:
    """Detail rows with the columns of their (key, chunk) row.  Null keys and null
    chunks (rows without a time) are groups like any other: no row is lost."""
    other = small.select(*[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in small.columns if c not in on])
    cond = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    return detail.join(other, cond, "inner").drop(*[f"_on_{c}" for c in on])


#: Rows that a chunk holds, and the most chunks of one order; beyond 2**28 rows chunks grow.
CHUNK_ROWS = 1 << 16
MOST_CHUNKS = 1 << 12


def volume_chunk(df: DataFrame, value: Column, rows: int = CHUNK_ROWS) -> Column:
    """Chunk numbers that rise with ``value`` (integers: times, ids), cut at its quantiles, so
    that about ``rows`` rows of all keys together are in each: a (key, chunk) holds no more,
    and a burst is cut as finely as a quiet time.  Rows of one value are in one chunk; a
    null has none.  One aggregate over ``df``, of one column."""
    return volume_cut(df, value, rows)(value)


def volume_cut(df: DataFrame, value: Column, rows: int = CHUNK_ROWS) -> Callable[[Column], Column]:
    """``volume_chunk`` as a function, for other columns on the same scale: a plan that is dear
    to compute is cut by the rows that it is made of."""
    fractions = _numbers([i / MOST_CHUNKS for i in range(1, MOST_CHUNKS)], "double")
    n, marks = df.agg(F.count(value), F.percentile_approx(value, fractions, 10 * MOST_CHUNKS)).first()
    parts = min(MOST_CHUNKS, -(-n // rows))
    bounds = sorted({marks[i * MOST_CHUNKS // parts - 1] for i in range(1, parts)})
    return lambda v: F.when(v.isNotNull(), below(bounds, v))


def _numbers(values: Sequence, kind: str) -> Column:
    """A literal array; one text is sent to the JVM instead of a literal per value."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def below(bounds: Sequence[int], value: Column) -> Column:
    """How many of the rising ``bounds`` are smaller than ``value``, by binary search."""
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    if not steps:
        return F.lit(0).cast("long")
    held = _numbers([*bounds, *[(1 << 63) - 1] * (2 * steps[0] - 1 - len(bounds))], "bigint")
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0),
                        lambda at, step: F.when(F.get(held, at + step - 1) < value, at + step).otherwise(at))
    return found.cast("long")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column,
                out: str) -> DataFrame:
    """Add column ``out`` = sum of ``value`` over rows of the same keys up to and
    including the current row in ``order`` (``order`` must be unique per key).
    ``chunk`` must be non-decreasing in ``order``."""
    keys = list(keys)
    d = df.withColumn("_chunk", chunk).withColumn("_v", value)
    totals = d.groupBy(*keys, "_chunk").agg(F.sum("_v").alias("_chunk_total"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_chunk",
                            F.coalesce(F.sum("_chunk_total").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_within", F.sum("_v").over(within))
    res = join_back(d, offsets, [*keys, "_chunk"])
    return res.withColumn(out, F.col("_offset") + F.col("_within")).drop("_chunk", "_v", "_within", "_offset")


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column,
                   out: str) -> DataFrame:
    """Add column ``out`` = ``value`` of the previous row of the same keys in
    ``order`` (null for a key's first row) — a ``lag`` that survives hot keys.

    Inside a (key, chunk) partition it is a plain ``lag``; a chunk's first row
    takes the last value of the key's nearest earlier non-empty chunk, found
    by a partial ``max_by`` per (key, chunk) and a window over that small table.
    """
    keys = list(keys)
    d = df.withColumn("_chunk", chunk).withColumn("_v", value)
    order_key = F.struct(*[F.col(c) for c in order])
    last = d.groupBy(*keys, "_chunk").agg(F.max_by("_v", order_key).alias("_last"))
    prev_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    carry = last.select(*keys, "_chunk", F.lag("_last").over(prev_chunk).alias("_in"))
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    d = d.withColumn("_lag", F.lag("_v").over(w)).withColumn("_first", F.row_number().over(w) == 1)
    res = join_back(d, carry, [*keys, "_chunk"])
    return res.withColumn(out, F.when(F.col("_first"), F.col("_in")).otherwise(F.col("_lag"))).drop(
        "_chunk", "_v", "_lag", "_first", "_in")


def running_max_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, value: Column,
                       out: str) -> DataFrame:
    """Add column ``out`` = max of ``value`` over the rows of the same keys that
    come strictly before the current row in ``order`` (null for the first).

    With no keys this is the watermark seen by each arriving row; like
    ``running_sum`` it is computed per chunk and stitched with chunk offsets,
    so no single task sees all rows.
    """
    keys = list(keys)
    d = df.withColumn("_chunk", chunk).withColumn("_v", value)
    tops = d.groupBy(*keys, "_chunk").agg(F.max("_v").alias("_chunk_max"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = tops.select(*keys, "_chunk", F.max("_chunk_max").over(before).alias("_in"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_within", F.max("_v").over(within))
    res = join_back(d, carry, [*keys, "_chunk"])
    return res.withColumn(out, F.greatest("_within", "_in")).drop("_chunk", "_v", "_within", "_in")


def running_sums_before(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                        values: dict[str, Column]) -> DataFrame:
    """Like ``running_sum`` for several values at once, but exclusive: each row
    sees the sums over the rows strictly before it (same chunked plan)."""
    keys = list(keys)
    d = df.withColumn("_chunk", chunk)
    for n, v in values.items():
        d = d.withColumn(f"_v_{n}", v)
    totals = d.groupBy(*keys, "_chunk").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in values])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_chunk", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}")
                                               for n in values])
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for n in values:
        d = d.withColumn(f"_w_{n}", F.coalesce(F.sum(f"_v_{n}").over(within), F.lit(0)))
    res = join_back(d, offsets, [*keys, "_chunk"])
    for n in values:
        res = res.withColumn(n, F.col(f"_o_{n}") + F.col(f"_w_{n}"))
    drop = ["_chunk"] + [f"_{p}_{n}" for n in values for p in ("v", "w", "o")]
    return res.drop(*drop)


def range_count(df: DataFrame, keys: Sequence[str], time_col: str, width_us: int, out: str,
                rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``out`` = number of rows of the same keys whose time is at most ``width_us`` before
    the row's own and not after it: COUNT(*) over a RANGE frame, rows of the same instant
    included.  A null time counts the rows without a time; a null key is a key.

    The frame is the difference of two prefix counts, up to the row's time and before the
    frame's start.  Rows are counted per (keys, instant) first, and each instant puts two
    marks into the order; nothing is copied by the number of rows that a frame holds, so a
    burst within one frame costs no more than the same rows far apart."""
    keys = list(keys)
    t = epoch_micros(time_col)
    per = df.groupBy(*keys, time_col).agg(F.count(F.lit(1)).alias("_n"))
    marks = per.select(*keys, time_col, F.explode(F.array(
        F.struct(t.alias("_at"), F.lit(1).alias("_end"), F.col("_n")),
        F.struct((t - width_us).alias("_at"), F.lit(0).alias("_end"), F.lit(0).cast("long").alias("_n")))).alias("_m"))
    marks = marks.select(*keys, time_col, "_m.*")
    # a frame's start comes before the rows of its instant; the chunks of the rows' times fit both
    chunk = volume_chunk(df.select(t.alias("_at")), F.col("_at"), rows)
    marks = running_sum(marks, keys, ["_at", "_end"], chunk, F.col("_n"), "_upto")
    counts = marks.groupBy(*keys, time_col).agg(
        F.sum(F.when(F.col("_end") == 1, F.col("_upto")).otherwise(-F.col("_upto"))).alias(out))
    return join_back(df, counts, [*keys, time_col])


def gap_sessions(df: DataFrame, keys: Sequence[str], order: Sequence[str], time_col: str, chunk: Column,
                 gap_ms: int, out: str = "session") -> DataFrame:
    """Add ``out`` = session number per key: a new session starts at a key's
    first row and wherever the time since the previous row exceeds ``gap_ms``.

    One shuffle of the detail rows, by (key, chunk): flags and their running
    count inside the chunk, plus a per-chunk summary (first/last time, flags
    after the first row) that is a partial aggregate over the same
    partitioning.  A window over the small (key, chunk) table decides whether
    each chunk's first row opens a session (gap to the previous chunk's last
    row) and the session offset of each chunk; a join brings it back.
    """
    keys = list(keys)
    t = F.col(time_col)
    d = df.withColumn("_chunk", chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    prev = F.lag(time_col).over(w)
    gap = F.timestamp_diff("MILLISECOND", prev, t)
    d = d.withColumn("_first", F.row_number().over(w) == 1) \
         .withColumn("_new", F.when(prev.isNotNull() & (gap > gap_ms), 1).otherwise(0))
    d = d.withColumn("_cum", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    summary = d.groupBy(*keys, "_chunk").agg(
        F.min(t).alias("_t0"), F.max(t).alias("_t1"), F.sum("_new").alias("_n_inner"))
    by_chunk = Window.partitionBy(*keys).orderBy("_chunk")
    prev_last = F.lag("_t1").over(by_chunk)
    opens = F.when(prev_last.isNull() | (F.timestamp_diff("MILLISECOND", prev_last, F.col("_t0")) > gap_ms), 1) \
             .otherwise(0)
    summary = summary.withColumn("_opens", opens).withColumn("_total", F.col("_n_inner") + F.col("_opens"))
    summary = summary.withColumn(
        "_offset", F.coalesce(F.sum("_total").over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    res = join_back(d, summary.select(*keys, "_chunk", "_opens", "_offset"), [*keys, "_chunk"])
    return res.withColumn(out, (F.col("_offset") + F.col("_opens") + F.col("_cum")).cast("bigint")).drop(
        "_chunk", "_first", "_new", "_cum", "_opens", "_offset")
