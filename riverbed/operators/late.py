"""Late data: arrival order, the watermark each row sees, and the late split.

Spark's streaming engine drops rows behind the watermark silently; the
reference routes them to a side output.  In batch form the arrival order is an
explicit column, the watermark a row sees is the running maximum event time
of the rows that arrived before it minus the allowed disorder, and a row is
late when its event time is behind that watermark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_millis
from riverbed.operators.running import running_max_before, volume_chunk


def disordered_arrival(df: DataFrame, ts: str = "ts", id_col: str = "event_id", max_shift_ms: int = 7000) -> DataFrame:
    """Add ``arrival_ms``: event time plus a deterministic shift of up to
    ``max_shift_ms`` (``id * 7919 % max_shift``), the disorder of the test input."""
    return df.withColumn("arrival_ms", epoch_millis(ts) + (F.col(id_col) * 7919) % max_shift_ms)


def with_watermark_seen(df: DataFrame, delay_ms: int, ts: str = "ts", arrival: str = "arrival_ms",
                        id_col: str = "event_id", marker: Column | None = None, out: str = "wm_ms") -> DataFrame:
    """Add ``out`` = (max event time over earlier arrivals) − ``delay_ms`` in epoch ms.

    ``marker`` restricts which rows advance the watermark (punctuated marks).
    The running max runs by chunks of arrival time (see ``running_max_before``):
    with no key, the chunk is what spreads the work, so its length follows the volume.
    """
    v = epoch_millis(ts)
    if marker is not None:
        v = F.when(marker, v)
    chunk = volume_chunk(df, F.col(arrival))
    d = running_max_before(df, [], [arrival, id_col], chunk, v, "_max_seen")
    return d.withColumn(out, F.col("_max_seen") - delay_ms).drop("_max_seen")


def is_late(ts: str = "ts", wm: str = "wm_ms") -> Column:
    return F.coalesce(epoch_millis(ts) < F.col(wm), F.lit(False))
