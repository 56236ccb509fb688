"""Connected-car queries: gap sessions, stop-delimited segments, the stop→moving+→stop
pattern, and event-time sort of disordered input.

All per-car sequences are gaps-and-islands built from the chunked ``lag`` and
running-count helpers, so one car with a third of the rows is still spread
over chunks cut by volume; segment measures are partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros
from riverbed.operators.late import disordered_arrival, is_late, with_watermark_seen
from riverbed.operators.running import gap_sessions, join_back, running_sum, volume_chunk
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views

CV = with_views("cars")
SESSION_GAP_MS = 6 * 3600 * 1000


def segment_measures(df: DataFrame, group: list[str]) -> DataFrame:
    """Start, length, max speed (int), population stddev of throttle and its label."""
    m = df.groupBy(*group).agg(
        F.min("event_time").alias("start_time"), F.count(F.lit(1)).alias("length"),
        F.max("speed").cast("int").alias("max_speed"), F.stddev_pop("throttle").alias("erraticness"))
    # the label is taken from the 6-digit value so a stddev that is 2.5 on paper
    # does not fall to either side by floating-point noise
    m = m.withColumn("erraticness", F.round("erraticness", 6))
    band = (F.col("erraticness") / 2.5).cast("int")
    return m.select(*group, "start_time", "length", "max_speed", "erraticness",
                    F.when(band == 0, "calm").when(band == 1, "busy").otherwise("crazy").alias("label"))


D_MEASURES = """min(event_time) AS start_time, count(*) AS length, CAST(trunc(max(speed)) AS INTEGER) AS max_speed,
  round(stddev_pop(throttle), 6) AS erraticness,
  CASE CAST(trunc(round(stddev_pop(throttle), 6) / 2.5e0) AS INTEGER) WHEN 0 THEN 'calm' WHEN 1 THEN 'busy' ELSE 'crazy' END AS label"""


@query("driving_sessions", CV + f"""
, g AS (SELECT *, CASE WHEN lag(event_time) OVER w IS NULL OR event_time - lag(event_time) OVER w > INTERVAL '6 hours'
                  THEN 1 ELSE 0 END AS new_s FROM cars WINDOW w AS (PARTITION BY car_id ORDER BY event_time, id)),
s AS (SELECT *, sum(new_s) OVER (PARTITION BY car_id ORDER BY event_time, id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT car_id, {D_MEASURES} FROM s GROUP BY car_id, session""")
def driving_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per car, sessions separated by more than 6 h without events, with segment measures (ST7).

    Same grouping as ``session_window(event_time, '6 hours')`` (rows exactly
    one gap apart stay together), written as islands so a hot car splits by
    volume: ``gap_sessions`` shuffles the detail rows once.
    """
    cars = views.cars(spark, sf_dir)
    c = gap_sessions(cars, ["car_id"], ["event_time", "id"], "event_time", volume_chunk(cars, epoch_micros("event_time")), SESSION_GAP_MS)
    return segment_measures(c, ["car_id", "session"]).drop("session")


def closed_segments(cars: DataFrame, least_stops: int) -> DataFrame:
    """Measures of the moving events between two stops of a car, or also before its
    first one (``least_stops`` 0).  Rows are numbered by the stops so far and reduced
    to segments; only those meet their car's number of stops, so a hot car's rows
    are never joined, and a null car is a car."""
    is_stop = F.coalesce(F.col("speed") == 0.0, F.lit(False))
    c = running_sum(cars, ["car_id"], ["event_time", "id"], volume_chunk(cars, epoch_micros("event_time")), is_stop.cast("bigint"), "stops_so_far")
    totals = cars.groupBy("car_id").agg(F.sum(is_stop.cast("bigint")).alias("total_stops"))
    segments = segment_measures(c.filter((F.col("speed") != 0.0) & (F.col("stops_so_far") >= least_stops)), ["car_id", "stops_so_far"])
    closed = join_back(segments, totals, ["car_id"]).filter(F.col("stops_so_far") < F.col("total_stops"))
    return closed.drop("stops_so_far", "total_stops")


STOPS_SQL = CV + """
, n AS (SELECT *, speed = 0e0 AS is_stop,
          sum(CASE WHEN speed = 0e0 THEN 1 ELSE 0 END) OVER (PARTITION BY car_id ORDER BY event_time, id
                                                             ROWS UNBOUNDED PRECEDING) AS stops_so_far,
          sum(CASE WHEN speed = 0e0 THEN 1 ELSE 0 END) OVER (PARTITION BY car_id) AS total_stops FROM cars)
"""


@query("driving_segments", STOPS_SQL + f"""
SELECT car_id, {D_MEASURES} FROM n WHERE NOT is_stop AND stops_so_far < total_stops GROUP BY car_id, stops_so_far""")
def driving_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stop event closes the car's current segment of moving events; the last,
    still open segment is not emitted (ST15: global window + trigger + evictor)."""
    return closed_segments(views.cars(spark, sf_dir), 0)


@query("cep_driving_segments", STOPS_SQL + f"""
SELECT car_id, {D_MEASURES} FROM n WHERE NOT is_stop AND stops_so_far >= 1 AND stops_so_far < total_stops
GROUP BY car_id, stops_so_far""")
def cep_driving_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern stop, one or more moving events, stop — strict contiguity (ST16):
    every run of moving events with a stop on both sides."""
    return closed_segments(views.cars(spark, sf_dir), 1)


SORT_DELAY_MS, SORT_SHIFT_MS = 30_000, 60_000


@query("car_event_sort", with_views("cars", dense=True) + f"""
, arr AS (SELECT *, (epoch_us(event_time) // 1000) + (id * 7919) % 60000 AS arrival_ms FROM cars),
wm AS (SELECT *, max(epoch_us(event_time) // 1000) OVER (ORDER BY arrival_ms, id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {SORT_DELAY_MS} AS wm_ms FROM arr)
SELECT car_id, id, event_time,
       CAST(row_number() OVER (PARTITION BY car_id ORDER BY event_time, id) AS BIGINT) AS seq
FROM wm WHERE NOT coalesce(epoch_us(event_time) // 1000 < wm_ms, FALSE)""")
def car_event_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per car, events in event-time order from disordered arrival; rows behind
    the 30 s watermark are dropped, ties kept; ``seq`` numbers the output (SO1)."""
    cars = views.cars(spark, sf_dir, dense=True)
    c = disordered_arrival(cars, ts="event_time", id_col="id", max_shift_ms=SORT_SHIFT_MS)
    c = with_watermark_seen(c, SORT_DELAY_MS, ts="event_time", id_col="id")
    ok = c.filter(~is_late("event_time")).select("car_id", "id", "event_time")
    r = running_sum(ok, ["car_id"], ["event_time", "id"], volume_chunk(cars, epoch_micros("event_time")), F.lit(1).cast("bigint"), "seq")
    return r.select("car_id", "id", "event_time", "seq")
