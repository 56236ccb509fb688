"""Streaming forms of batch operators.  Inputs are streams whose event-time
columns are instants (``as_event_time``); each function returns a streaming
DataFrame for append mode.  ``tests/test_streaming.py`` checks each against
its batch form after a flush row has closed every window and timer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riverbed.functions import geo
from riverbed.session import ROCKSDB_PROVIDER


def cleansing_stream(rides: DataFrame) -> DataFrame:
    """PF6, stateless: the batch filter as is."""
    return rides.filter(geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))


def enrich_stream(rides: DataFrame, fares: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Stream-stream inner join of START rides and fares on ride id.  Both
    sides carry a watermark and the join a time bound, so Spark can drop join
    state once a ride's fare can no longer arrive."""
    # watermarks are taken at the sources, before any filter, so every row
    # (a flush row too) advances event time
    r = rides.withWatermark("start_time", delay).filter("is_start").select(
        "ride_id", "taxi_id", "driver_id", F.col("start_time").alias("r_time"), "passenger_cnt")
    f = fares.withWatermark("start_time", delay).select(
        F.col("ride_id").alias("f_ride_id"), F.col("start_time").alias("f_time"), "payment_type", "tip", "total_fare")
    cond = (F.col("ride_id") == F.col("f_ride_id")) & F.col("f_time").between(
        F.col("r_time") - F.expr("INTERVAL 1 HOUR"), F.col("r_time") + F.expr("INTERVAL 1 HOUR"))
    return r.join(f, cond, "inner").drop("f_ride_id", "f_time")


def unmatched_stream(rides: DataFrame, fares: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Full outer stream-stream join with a time bound; once the watermark
    passes the bound, a side without partner is emitted with nulls — these
    are the unmatched rides and fares (the reference's side outputs)."""
    r = (rides.withWatermark("start_time", delay).filter("is_start").filter(F.col("ride_id") % 1000 != 0)
         .select(F.col("ride_id").alias("r_id"), F.col("start_time").alias("r_time")))
    f = fares.withWatermark("start_time", delay).select(F.col("ride_id").alias("f_id"), F.col("start_time").alias("f_time"))
    cond = (F.col("r_id") == F.col("f_id")) & F.col("f_time").between(
        F.col("r_time") - F.expr("INTERVAL 1 HOUR"), F.col("r_time") + F.expr("INTERVAL 1 HOUR"))
    j = r.join(f, cond, "full_outer")
    return j.filter(F.col("r_id").isNull() | F.col("f_id").isNull())


def sessions_stream(cars: DataFrame, gap: str = "6 hours", delay: str = "1 minute") -> DataFrame:
    """ST7: gap sessions per car with the built-in ``session_window``."""
    c = cars.withWatermark("event_time", delay)
    return c.groupBy(F.session_window("event_time", gap).alias("s"), "car_id").agg(
        F.min("event_time").alias("start_time"), F.count(F.lit(1)).alias("length"),
        F.max("speed").cast("int").alias("max_speed"), F.stddev_pop("throttle").alias("erraticness"))


def hourly_tips_max_stream(fares: DataFrame, delay: str = "1 minute") -> DataFrame:
    """ST10: two chained event-time aggregations in append mode — per driver and
    hour, then per hour over drivers — linked by ``window_time``."""
    per = (fares.withWatermark("start_time", delay)
           .groupBy(F.window("start_time", "1 hour"), "driver_id").agg(F.sum("tip").alias("total_tips"))
           .select(F.window_time("window").alias("t"), "driver_id", "total_tips"))
    best = F.max_by(F.struct("driver_id", "total_tips"), F.struct("total_tips", -F.col("driver_id")))
    return per.groupBy(F.window("t", "1 hour")).agg(best.alias("b")).select(
        F.col("window.end").alias("window_end"), "b.driver_id", "b.total_tips")


class TempJumpProcessor(StatefulProcessor):
    """W2 with value state: the sensor's last temperature survives between
    micro-batches; rows of a batch are taken in arrival (event id) order."""

    def __init__(self, ratio: float):
        self.ratio = ratio

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "temp double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("event_id")
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for eid, temp in zip(batch["event_id"], batch["temp"]):
            if last is not None and last > 0 and temp / last > self.ratio:
                out.append((key[0], int(eid), float(temp), float(last)))
            last = float(temp)
        self.last.update((last,))
        if out:
            yield pd.DataFrame(out, columns=["sensor_id", "event_id", "temp", "last_temp"])

    def close(self) -> None:
        pass


def temp_jump_stream(sensors: DataFrame, ratio: float = 1.7) -> DataFrame:
    spark = sensors.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return sensors.select("sensor_id", "event_id", "temp").groupBy("sensor_id").transformWithStateInPandas(
        statefulProcessor=TempJumpProcessor(ratio),
        outputStructType="sensor_id long, event_id long, temp double, last_temp double",
        outputMode="Append", timeMode="None")


def lookup_stream(sensors: DataFrame, rooms: DataFrame) -> DataFrame:
    """Stream-static left join with a dimension table; a miss is UNKNOWN ROOM."""
    return sensors.join(rooms, "sensor_id", "left").select(
        "event_id", "sensor_id", "temp", F.coalesce(F.col("room"), F.lit("UNKNOWN ROOM")).alias("room"))


def dedup_stream(events: DataFrame, keys: list[str], time_col: str, delay: str = "1 minute") -> DataFrame:
    """Exact duplicates (same keys and event time) dropped; the watermark
    lets Spark forget keys once no copy can still arrive."""
    return events.withWatermark(time_col, delay).dropDuplicates([*keys, time_col])


def window_max_stream(sensors: DataFrame, size: str = "10 seconds", delay: str = "1 minute") -> DataFrame:
    """Per sensor windowed maximum in append mode."""
    w = sensors.withWatermark("ts", delay).groupBy(F.window("ts", size), "sensor_id").agg(F.max("temp").alias("max_temp"))
    return w.select("sensor_id", F.col("window.end").alias("window_end"), "max_temp")


def running_totals_stream(sensors: DataFrame) -> DataFrame:
    """A1 in update mode: each micro-batch re-emits the changed per-sensor totals."""
    return sensors.groupBy("sensor_id").agg(F.sum("temp").alias("running_sum"), F.max("event_id").alias("last_event_id"))


def latest_ride_stream(rides: DataFrame) -> DataFrame:
    """W3 in update mode: newest event per taxi by (time, START first, ride id)."""
    order = F.struct("event_time", (~F.col("is_start")).alias("is_end"), "ride_id")
    return rides.groupBy("taxi_id").agg(F.max_by(F.struct("ride_id", "is_start", "event_time"), order).alias("b")).select(
        "taxi_id", "b.ride_id", "b.is_start", "b.event_time")
