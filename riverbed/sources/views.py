"""Derived record views over the driver's tables.

The reference's programs read rides, fares, car events, heartbeats, mails and
weighted edges.  These views re-express those record types over the parquet
tables (definitions fixed in FIXTURES.md) so each operator runs on real volume
and its work grows with the tables.  All are lazy projections/filters of one
scan, except ``edges`` (a star join + aggregate).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros, from_epoch_micros
from riverbed.sources.tables import table


#: In dense views half a second of the tables is a millisecond: gaps of minutes become
#: fractions of a second, so windows of seconds hold many rows and rows can come late.
DENSE = 500
BEAT_SHIFT_MS = 600_000


def events(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    us = F.expr(f"epoch_us div {DENSE}")
    return ev.withColumn("epoch_us", epoch_micros("ts")).withColumn("ts", from_epoch_micros(us)).drop("epoch_us") if dense else ev


def _ride_geo(eid: Column) -> list[Column]:
    # fixed values: synthetic coordinate lattice of the rides view (FIXTURES.md)
    return [
        (F.lit(-74.04) + F.lit(0.02) * ((eid * 7) % 20)).alias("start_lon"),
        (F.lit(40.51) + F.lit(0.04) * ((eid * 11) % 14)).alias("start_lat"),
        (F.lit(-74.04) + F.lit(0.02) * ((eid * 3) % 20)).alias("end_lon"),
        (F.lit(40.51) + F.lit(0.04) * ((eid * 5) % 14)).alias("end_lat"),
    ]


def ride_end_time(ts: Column, value: Column) -> Column:
    return F.timestamp_add("SECOND", F.round(value * 180).cast("int"), ts)


def rides_from_events(ev: DataFrame) -> DataFrame:
    """START and END ride events; ~1/41 of rides lose their START, ~1/50 their END."""
    eid = F.col("event_id")
    common_tail = [(eid % 6 + 1).alias("passenger_cnt"), F.col("user_id").alias("taxi_id"),
                   (F.col("user_id") % 40).alias("driver_id")]
    starts = ev.filter(eid % 41 != 0).select(
        eid.alias("ride_id"), F.lit(True).alias("is_start"), F.col("ts").alias("event_time"),
        F.col("ts").alias("start_time"), F.lit(None).cast("timestamp_ntz").alias("end_time"),
        *_ride_geo(eid), *common_tail)
    end_ts = ride_end_time(F.col("ts"), F.col("value"))
    ends = ev.filter(eid % 50 != 0).select(
        eid.alias("ride_id"), F.lit(False).alias("is_start"), end_ts.alias("event_time"),
        F.col("ts").alias("start_time"), end_ts.alias("end_time"),
        *_ride_geo(eid), *common_tail)
    return starts.unionByName(ends)


def rides(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    return rides_from_events(events(spark, sf_dir, dense))


def fares(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    ev = events(spark, sf_dir, dense)
    eid = F.col("event_id")
    return ev.filter(eid % 37 != 0).select(
        eid.alias("ride_id"), F.col("user_id").alias("taxi_id"), (F.col("user_id") % 40).alias("driver_id"),
        F.col("ts").alias("start_time"),
        F.when(eid % 2 == 0, "CSH").otherwise("CRD").alias("payment_type"),
        (F.col("value") / 10).alias("tip"), F.lit(0.0).alias("tolls"), F.col("value").alias("total_fare"))


def cars(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    ev = events(spark, sf_dir, dense)
    return ev.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("car_id"), F.col("ts").alias("event_time"),
        F.when(F.col("event_type").isin("error", "signup"), F.lit(0.0)).otherwise(F.col("value")).alias("speed"),
        (F.col("event_id") % 20).alias("throttle"))


def beats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeats in the order of their event id; times run up to ten minutes ahead, so some are not newer than those before."""
    ev = events(spark, sf_dir, dense=True)
    ahead = F.timestamp_add("MILLISECOND", (F.col("event_id") * 7919) % BEAT_SHIFT_MS, F.col("ts"))
    return ev.select(
        F.col("user_id").alias("instance_id"), F.col("event_type").alias("product_id"),
        (F.col("user_id") % 10).alias("customer_id"), "event_id", ahead.alias("ts"))


def sensors(spark: SparkSession, sf_dir: str, dense: bool = False) -> DataFrame:
    """``events`` read as sensor readings: (sensor id, time, temperature)."""
    ev = events(spark, sf_dir, dense)
    return ev.select("event_id", F.col("user_id").alias("sensor_id"), "ts", F.col("value").alias("temp"))


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    cid, turn = F.col("conv_id"), F.col("turn")
    sent = F.timestamp_add("MINUTE", turn, F.timestamp_add("HOUR", cid, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    return conv.select(
        F.concat_ws("-", cid.cast("string"), turn.cast("string")).alias("message_id"),
        sent.alias("sent"),
        F.concat(F.col("role"), F.lit(" <"), F.col("role"), (cid % 25).cast("string"), F.lit("@example.org>")).alias("sender"),
        F.when(turn == 0, F.lit("null")).otherwise(F.concat_ws("-", cid.cast("string"), (turn - 1).cast("string"))).alias("reply_to"),
        F.col("text").alias("body"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue flowing from supplier nation to customer nation.

    lineitem ⋈ orders is the only big join: both sides shuffle on the order
    key (or AQE turns it into a broadcast when orders is small).  Nation,
    supplier and customer are left to the planner's size-checked threshold.
    The aggregate is partial (map-side) before the shuffle on (src, dst).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    sn = n.select(F.col("n_nationkey").alias("sk"), F.col("n_name").alias("src"))
    cn = n.select(F.col("n_nationkey").alias("ck"), F.col("n_name").alias("dst"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, F.col("o_custkey") == c.c_custkey)
         .join(s, F.col("l_suppkey") == s.s_suppkey)
         .join(cn, F.col("c_nationkey") == F.col("ck"))
         .join(sn, F.col("s_nationkey") == F.col("sk")))
    return j.groupBy("src", "dst").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("w"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.select(
        eid, "ts", (F.col("user_id") % 20).alias("client_id"), (eid % 4).alias("publisher_id"),
        (eid % 5).alias("offer_id"), F.when(eid % 3 == 0, F.lit(None)).otherwise(eid % 7).alias("campaign_id"))


def alert_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.filter((F.col("event_type") == "signup") & (eid % 10 == 0)).select(
        eid.alias("alert_use_id"), (F.col("user_id") % 20).alias("client_id"), (eid % 3 + 1).alias("entity_type_id"),
        (eid % 4).alias("entity_id"), F.col("ts").alias("begin_ts"),
        F.timestamp_add("HOUR", F.lit(6), F.col("ts")).alias("end_ts"))


def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule update in the order it was set; a threshold below 1 removes the rule."""
    ev = table(spark, sf_dir, "events")
    return ev.filter((F.col("event_type") == "view") & (F.col("user_id") % 3 == 0)).select(
        F.col("user_id").alias("id"), F.col("event_id").alias("rule_id"),
        (F.lit(0.5) + (F.col("event_id") % 5)).alias("threshold"), F.col("ts").alias("set_at"))
