"""User-defined function surface: a vectorised scalar UDF registered for SQL (U1),
an Arrow table function for row fan-out (U2), and aggregate / full-window
functions written as per-batch pandas partials merged by Spark (U3, U4).

The partial pattern is the reference's create/add/merge/result accumulator:
``mapInPandas`` folds each Arrow batch into (key, window) partial states, so
no group is ever held whole in one Python worker, and Spark's own aggregate
merges the partials after the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf

from riverbed.operators.whole import rise_of_piece, rise_of_pieces, RISE_PIECE, whole_window
from riverbed.functions.geo import CORNER, DELTA_LAT, DELTA_LON, LAT_NORTH, LON_WEST, SLOPE_EPS
from riverbed.plans import basics  # noqa: F401  (registers flatmap_split, whose oracle U2 shares)
from riverbed.plans.geo_places import ON_WAY_SQL
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import _ORACLE, query
from riverbed.sources import views


@F.pandas_udf(T.LongType())
def cells_on_way_count(lon1: pd.Series, lat1: pd.Series, lon2: pd.Series, lat2: pd.Series) -> pd.Series:
    """Number of grid cells on the straight path between two points: all columns
    of a batch's paths side by side, summed per path (null coordinates: null)."""
    pts = pd.DataFrame({"a": lon1, "b": lat1, "c": lon2, "d": lat2}).astype("float64")
    known = pts.notna().all(axis=1).to_numpy()
    out = pd.array([None] * len(pts), dtype="Int64")
    a, b, c, e = pts[known].to_numpy().T
    gx = lambda lon: np.floor((abs(LON_WEST) - np.abs(lon)) / DELTA_LON)
    gy = lambda lat: np.floor((LAT_NORTH - lat) / DELTA_LAT)
    w, d = np.abs(gx(a) - gx(c)).astype(np.int64), np.abs(gy(b) - gy(e))
    slope = d / (w + SLOPE_EPS)
    row = np.repeat(np.arange(len(w)), w + 1)
    start = np.cumsum(w + 1) - (w + 1)
    i = np.arange(len(row)) - start[row]
    first = np.where(i == 0, 0, np.ceil((i - 0.5) * slope[row] - 0.5 + CORNER))
    last = np.where(i == w[row], d[row],
                    np.maximum(first, np.floor((i + 0.5) * slope[row] - 0.5 - CORNER) + 1))
    if len(w):
        out[known] = np.add.reduceat(last - first + 1, start).astype(np.int64)
    return pd.Series(out)


@query("udf_scalar", ON_WAY_SQL + """
SELECT unnest(ride_ids) AS ride_id, n_cells FROM (
  SELECT ride_ids, count(*) AS n_cells FROM on_way GROUP BY ride_ids)""")
def udf_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scalar function class registered by name and called from SQL (U1): an
    Arrow-batched pandas UDF over the columns of each path."""
    spark.udf.register("cells_on_way_count", cells_on_way_count)
    views.rides(spark, sf_dir).createOrReplaceTempView("rides")
    return spark.sql("""SELECT ride_id, cells_on_way_count(start_lon, start_lat, end_lon, end_lat) AS n_cells
                        FROM rides WHERE is_start""")


@udtf(returnType="pos: bigint, part: string", useArrow=True)
class SplitId:
    """Row fan-out: one output row per ``_``-separated part of an id."""

    def eval(self, name: str):
        for i, p in enumerate(name.split("_")):
            yield i, p


@query("udtf_split", None)
def udtf_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udtf.register("split_id", SplitId)
    views.sensors(spark, sf_dir).createOrReplaceTempView("sensors")
    return spark.sql("""SELECT s.event_id, t.pos, t.part
                        FROM sensors s, LATERAL split_id(concat('sensor_', CAST(s.sensor_id AS STRING))) t""")


_ORACLE["udtf_split"] = _ORACLE["flatmap_split"]


def _partial_batches(key_cols: list[str], value: str, states: dict[str, str]):
    """mapInPandas body: fold each Arrow batch into partial states per key."""
    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                g = b.groupby(key_cols, sort=False)[value]
                yield g.agg(**{n: f for n, f in states.items()}).reset_index()
    return fold


def _windowed(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    s = views.sensors(spark, sf_dir)
    w = F.window("ts", size)
    return s.select("sensor_id", w.start.alias("window_start"), w.end.alias("window_end"), "temp")


@query("udaf_avg", with_views("sensors") + """
SELECT time_bucket(INTERVAL '15 seconds', ts) AS window_start, sensor_id, round(avg(temp), 6) AS avg_temp
FROM sensors GROUP BY ALL""")
def udaf_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average as an accumulator with create/add/merge/result."""
    d = _windowed(spark, sf_dir, "15 seconds").drop("window_end")
    schema = "sensor_id long, window_start timestamp_ntz, s double, c long"
    part = d.mapInPandas(_partial_batches(["sensor_id", "window_start"], "temp", {"s": "sum", "c": "count"}), schema)
    merged = part.groupBy("window_start", "sensor_id").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    return merged.select("window_start", "sensor_id", F.round(F.col("s") / F.col("c"), 6).alias("avg_temp"))


@query("udf_group_apply", with_views("sensors") + """
SELECT sensor_id, min(temp) AS min_temp, max(temp) AS max_temp,
       time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end
FROM sensors GROUP BY sensor_id, time_bucket(INTERVAL '5 seconds', ts)""")
def udf_group_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-window function with key and window metadata (MinMaxTemp) in pandas
    (A19, U4), as partial states per batch merged after the shuffle."""
    d = _windowed(spark, sf_dir, "5 seconds").drop("window_start")
    schema = "sensor_id long, window_end timestamp_ntz, lo double, hi double"
    part = d.mapInPandas(_partial_batches(["sensor_id", "window_end"], "temp", {"lo": "min", "hi": "max"}), schema)
    return part.groupBy("sensor_id", "window_end").agg(F.min("lo").alias("min_temp"), F.max("hi").alias("max_temp")).select(
        "sensor_id", "min_temp", "max_temp", "window_end")


@query("whole_window_rise", with_views("sensors", dense=True) + """
, x AS (SELECT *, time_bucket(INTERVAL '10 minutes', ts) AS ws FROM sensors WHERE temp IS NOT NULL),
steps AS (SELECT *, lag(temp) OVER (PARTITION BY sensor_id, ws ORDER BY ts, event_id) AS prev FROM x),
runs AS (SELECT *, sum(CASE WHEN prev IS NULL OR temp <= prev THEN 1 ELSE 0 END)
                   OVER (PARTITION BY sensor_id, ws ORDER BY ts, event_id) AS run FROM steps),
sized AS (SELECT sensor_id, ws, run, count(*) AS len, sum(CASE WHEN temp > prev THEN temp - prev ELSE 0 END) AS climb
          FROM runs GROUP BY ALL)
SELECT sensor_id, ws AS window_start, CAST(sum(len) AS BIGINT) AS n_rows, max(len) AS longest_rise, round(sum(climb), 6) AS climb
FROM sized GROUP BY ALL""")
def whole_window_rise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function of a whole window's rows in their order (A19, U4): its longest strictly
    rising run and the sum of its rises, as a fold of ordered pieces."""
    s = views.sensors(spark, sf_dir, dense=True).filter(F.col("temp").isNotNull())
    rows = s.select("sensor_id", F.window("ts", "10 minutes").start.alias("window_start"), "ts", "event_id", "temp")
    return whole_window(rows, ["sensor_id", "window_start"], "ts", ["event_id"], rise_of_piece, RISE_PIECE, rise_of_pieces,
                        "n_rows long, longest_rise long, climb double").withColumn("climb", F.round("climb", 6))
