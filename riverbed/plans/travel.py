"""Travel-time prediction (ST25): a per (destination cell, direction bucket) model
trained online on finished rides and asked at each ride start."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions import geo
from riverbed.functions.time import epoch_micros, minutes_between
from riverbed.operators.running import running_sums_before, volume_chunk
from riverbed.plans.geo_places import D_CELL, D_DIST, D_IN_NYC, cleansed
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views


def travel_time_df(rides: DataFrame) -> DataFrame:
    """Slope-only regression through the origin, minutes = slope · distance, with
    sums Σxy, Σx², n over the END rows of the same (cell, bucket) strictly before
    each START (START sorts before END at equal times).  Prediction truncated
    to int after rounding to 6 digits (so summation order cannot move a value
    across an integer); −1 while the model has fewer than two points or when Σx² = 0
    (no slope).  The bucket is the direction from the end back to the start."""
    r = cleansed(rides).select(
        "ride_id", "is_start", "event_time",
        geo.grid_cell("end_lon", "end_lat").alias("cell"),
        (geo.direction("end_lon", "end_lat", "start_lon", "start_lat") / 45).cast("int").alias("bucket"),
        geo.distance("start_lon", "start_lat", "end_lon", "end_lat").alias("x"),
        F.when(~F.col("is_start"), minutes_between("start_time", "end_time")).alias("y"))
    is_end = ~F.col("is_start")
    s = running_sums_before(
        r.withColumn("is_end", is_end), ["cell", "bucket"], ["event_time", "is_end", "ride_id"],
        volume_chunk(r, epoch_micros("event_time")),
        {"sxy": F.when(is_end, F.col("x") * F.col("y")).otherwise(0.0),
         "sxx": F.when(is_end, F.col("x") * F.col("x")).otherwise(0.0),
         "n": F.when(is_end, 1).otherwise(0).cast("bigint")})
    pred = (F.when(F.col("n") < 2, F.lit(-1))
            .when(F.col("sxx") == 0, F.lit(-1))
            .otherwise(F.round(F.col("sxy") / F.col("sxx") * F.col("x"), 6).cast("int")))
    return s.filter("is_start").select("ride_id", "cell", "bucket", pred.alias("predicted"))


@query("travel_time_prediction", with_views("rides") + f"""
, c AS (SELECT * FROM rides WHERE {D_IN_NYC.format(lon="start_lon", lat="start_lat")}
                               AND {D_IN_NYC.format(lon="end_lon", lat="end_lat")}),
p AS (SELECT ride_id, is_start, event_time, {D_CELL.format(lon="end_lon", lat="end_lat")} AS cell,
        CAST(trunc((CAST(trunc(degrees(atan2(start_lat - end_lat, (start_lon - end_lon) * cos(end_lat)))) AS INTEGER) + 179)
                   / 45e0) AS INTEGER) AS bucket,
        {D_DIST.format(lon1="start_lon", lat1="start_lat", lon2="end_lon", lat2="end_lat")} AS x,
        CASE WHEN NOT is_start THEN ((epoch_us(end_time) - epoch_us(start_time)) // 1000) / 60000e0 END AS y FROM c),
s AS (SELECT *, coalesce(sum(CASE WHEN NOT is_start THEN x * y ELSE 0e0 END) OVER w, 0e0) AS sxy,
               coalesce(sum(CASE WHEN NOT is_start THEN x * x ELSE 0e0 END) OVER w, 0e0) AS sxx,
               count(CASE WHEN NOT is_start THEN 1 END) OVER w AS n
      FROM p WINDOW w AS (PARTITION BY cell, bucket ORDER BY event_time, NOT is_start, ride_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT ride_id, cell, bucket,
       CASE WHEN n < 2 THEN -1 WHEN sxx = 0 THEN -1 ELSE CAST(trunc(round(sxy / sxx * x, 6)) AS INTEGER) END AS predicted
FROM s WHERE is_start""")
def travel_time_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return travel_time_df(views.rides(spark, sf_dir))
