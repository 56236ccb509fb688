"""Event-time windows: tumbling and sliding aggregates, top-1.

All windowed aggregates are plain ``groupBy(window(...), keys)`` so Spark runs a
partial aggregate before the shuffle and a final one after it; the window
struct is flattened into ``window_start`` / ``window_end`` columns.  The same
functions work on a streaming DataFrame (with a watermark set by the caller).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _flatten(df: DataFrame, keys: Sequence[str], agg_names: Sequence[str]) -> DataFrame:
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        *keys, *agg_names)


def _agg(df, grouping, aggs: dict[str, Column]) -> DataFrame:
    return df.groupBy(*grouping).agg(*[c.alias(n) for n, c in aggs.items()])


def tumbling_agg(df: DataFrame, time_col: str, size: str, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    out = _agg(df, [F.window(time_col, size), *keys], aggs)
    return _flatten(out, keys, list(aggs))


def sliding_agg(df: DataFrame, time_col: str, size: str, slide: str, keys: Sequence[str],
                aggs: dict[str, Column]) -> DataFrame:
    out = _agg(df, [F.window(time_col, size, slide), *keys], aggs)
    return _flatten(out, keys, list(aggs))


def top1_per_group(df: DataFrame, group: Sequence[str], value: str, tiebreak: str, keep: Sequence[str]) -> DataFrame:
    """Row with the largest ``value`` per group; ties go to the smaller ``tiebreak``.

    A ``max_by`` aggregate rather than a ranking window: it is a partial
    aggregate, so a hot group is pre-reduced on the map side and only one
    struct per group and partition crosses the shuffle.
    """
    best = F.max_by(F.struct(*[F.col(c) for c in keep]), F.struct(F.col(value), -F.col(tiebreak)))
    return df.groupBy(*group).agg(best.alias("_best")).select(*group, *[F.col("_best")[c].alias(c) for c in keep])
