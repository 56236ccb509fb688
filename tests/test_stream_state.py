"""Replayed streams: known micro-batches, null and -1 keys, state left behind."""

import datetime as dt

from pyspark.sql import functions as F

from riverbed.functions.time import epoch_millis, to_instant
from riverbed.plans import alerts, rules, stream_state
from riverbed.sources import views
from riverbed.streaming.keyed_state import (KEY, early_fire_stream, expiring_jump_stream, held_rule_stream, late_window_stream,
                                             retry_join_stream, switch_stream, threshold_stream)
from riverbed.streaming.replay import by_volume, replay, state, state_of_key
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def left(spark, ckpt, variable):
    """State of real rows; the flush row's own window stays open."""
    return state(spark, ckpt, variable).filter("not key._flush").count()


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def test_batches_follow_volume(spark):
    df = spark.range(0, 1000).select((F.col("id") * F.col("id")).alias("t"))
    sizes = [r["count"] for r in df.groupBy(by_volume(df, F.col("t"), 5).alias("b")).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 2 * min(sizes)
    assert df.filter("false").groupBy(by_volume(df.filter("false"), F.col("t")).alias("b")).count().count() == 0


def test_late_rows_of_all_kinds_are_in_the_data(spark):
    marks = {r["mark"] for r in stream_state.late_updates_stream(spark, SF_SMALL).select("mark").distinct().collect()}
    assert marks == {"first", "update", "dropped"}


def test_lateness_by_hand(spark):
    """Window [0, 10): fired in the batch after the one that moves the watermark to 12,
    updated by a row at watermark 12, dropped at watermark 15; a null key is a key."""
    rows = [(0, 1, -1, 1), (0, 2, None, 2), (0, 3, -1, 17), (1, 4, -1, 3), (1, 5, None, 20), (2, 6, -1, 4), (2, 7, None, 5), (2, 8, -1, 6)]
    df = spark.createDataFrame([(b, i, k, at(s), i) for b, i, k, s in rows],
                               "b int, event_id long, key long, ts timestamp_ntz, arrival_ms long")
    out, ckpt = replay(df, F.col("b"), lambda s: late_window_stream(s.withColumn("ts", to_instant("ts")), "5 seconds", 10_000, 5_000),
                       "by-hand", flush_time="ts")
    base = int((T0 - dt.datetime(1970, 1, 1)).total_seconds() * 1000)
    got = sorted(((r["key"], (r["end_ms"] - base) // 1000, r["cnt"], r["mark"]) for r in out.collect()), key=str)
    assert got == sorted([(-1, 10, 1, "first"), (-1, 10, 2, "update"), (None, 10, 1, "first"), (-1, 10, 1, "dropped"),
                          (-1, 10, 1, "dropped"), (None, 10, 1, "dropped"), (-1, 20, 1, "first"), (None, 30, 1, "first")], key=str)
    assert left(spark, ckpt, "windows") == 0


def test_rules_and_rows_with_null_and_minus_one_keys(spark):
    rows = [(k, t, is_row, seq, v) for k in (None, -1) for t, is_row, seq, v in
            [(1, 1, 1, 10.0), (2, 1, 2, 30.0), (3, 0, 1, 1.5), (4, 1, 3, 50.0), (5, 0, 2, 0.5), (6, 1, 4, 90.0), (7, 1, 5, 400.0)]]
    df = spark.createDataFrame(rows, "sensor_id long, ts_us long, is_row int, seq long, value double")
    out, _ = replay(df, F.col("ts_us"), lambda s: threshold_stream(s, alerts.DEFAULT_THRESHOLD), "rules")
    got = sorted(((r["sensor_id"], r["event_id"]) for r in out.collect()), key=str)
    assert got == sorted([(k, e) for k in (None, -1) for e in (3, 5)], key=str)


def test_held_rules_end_and_leave_no_state(spark):
    """Rule 1 holds [1, 5); rule 2 arrives meanwhile and is lost; rule 3 arrives at 5 and is taken."""
    none = None
    rows = [(1, 0, 1, 5), (2, 1, 100, none), (3, 0, 2, 9), (4, 1, 101, none), (5, 0, 3, 7), (5, 1, 102, none), (8, 1, 103, none)]
    df = spark.createDataFrame([(c, 1, 4, at(t), r, s, e and int((at(e) - dt.datetime(1970, 1, 1)).total_seconds() * 10**6))
                                for c in (None, -1) for t, r, s, e in rows],
                               "client_id long, entity_type_id int, entity_id long, ts timestamp_ntz, is_row int, seq long, end_us long")
    out, ckpt = replay(df, epoch_millis("ts"), lambda s: held_rule_stream(s.withColumn("ts", to_instant("ts"))), "held", flush_time="ts")
    got = sorted(((r["client_id"], r["event_id"], r["alert_use_id"]) for r in out.select(*KEY, "event_id", "alert_use_id").collect()), key=str)
    assert got == sorted([(c, e, a) for c in (None, -1) for e, a in ((100, 1), (101, 1), (102, 3))], key=str)
    assert left(spark, ckpt, "held") == 0


def test_early_firing_renews_and_purges(spark):
    df = spark.createDataFrame([(None, at(0.5)), (None, at(3.2)), (-1, at(9.0)), (-1, at(30.0))], "sensor_id long, ts timestamp_ntz")
    out, ckpt = replay(df, epoch_millis("ts"), lambda s: early_fire_stream(s.withColumn("ts", to_instant("ts")), rules.FIRE_WINDOW_S * 1000),
                       "early", flush_time="ts")
    got = [(r["sensor_id"], r["cnt"]) for r in out.orderBy("end_ms", "tick_ms").collect()]
    assert [c for k, c in got if k is None] == [1, 1, 1, 2, 2, 2, 2, 2, 2, 2]
    assert [c for k, c in got if k == -1] == [1] + [1] * 10
    assert left(spark, ckpt, "next") == left(spark, ckpt, "counts") == 0


def test_point_lookup_opens_one_partition(spark):
    s = views.sensors(spark, SF_SMALL)
    ckpt = stream_state.latest_max_checkpoint(s)
    every = state(spark, ckpt)
    for sensor in [r[0] for r in s.select("sensor_id").distinct().orderBy("sensor_id").limit(3).collect()]:
        one = state_of_key(spark, ckpt, F.lit(sensor).cast("long"))
        assert one.rdd.getNumPartitions() == 1 and every.rdd.getNumPartitions() > 1
        assert one.collect() == every.filter(F.col("key.sensor_id") == sensor).collect()


def test_waiting_trades_are_answered(spark):
    """Customer 1's row arrives after the trade but before the watermark reaches it; customer 2's never; a null id is a customer."""
    rows = [(0, 1, None, True, 10, None), (0, 2, 1, True, 10, None), (0, 3, 2, True, 10, None), (0, 4, 1, False, 4, "a"),
            (1, 5, None, False, 5, "n"), (1, 6, 1, True, 30, None), (2, 7, 9, True, 12, None), (2, 8, None, True, 40, None)]
    df = spark.createDataFrame([(b, c, at(t), i, i, x, info) for b, i, c, x, t, info in rows],
                               "b int, customer_id long, ts timestamp_ntz, arrival_ms long, event_id long, is_trade boolean, info string")
    out, ckpt = replay(df, F.col("b"), lambda s: retry_join_stream(s.withColumn("ts", to_instant("ts")), "5 seconds"),
                       "retry", flush_time="ts")
    got = sorted((r["trade_id"], r["customer_id"], r["customer_info"], r["answered"]) for r in out.collect())
    assert got == [(1, None, "n", "waited"), (2, 1, "a", "waited"), (3, 2, None, "waited"), (6, 1, "a", "at once"),
                   (7, 9, None, "late"), (8, None, "n", "at once")]
    assert left(spark, ckpt, "waiting") == 0


def test_gate_closes_and_last_reading_expires(spark):
    """The gate opened at 0 and again at 5 is open until 15; readings 9 seconds apart are compared, 11 apart are not."""
    rows = [(0, 0, None, None), (4, 1, 1, 10.0), (5, 0, None, None), (13, 1, 2, 30.0), (15, 1, 3, 60.0), (16, 1, 4, 70.0),
            (27, 1, 5, 700.0), (36, 1, 6, 9000.0)]
    df = spark.createDataFrame([(k, at(t), r, i, v) for k in (None, -1) for t, r, i, v in rows],
                               "sensor_id long, ts timestamp_ntz, is_row int, seq long, value double")
    instant = lambda s: s.withColumn("ts", to_instant("ts"))
    out, ckpt = replay(df, epoch_millis("ts"), lambda s: switch_stream(instant(s), 10 * 10**6), "gate", flush_time="ts")
    assert sorted(((r["sensor_id"], r["event_id"]) for r in out.collect()), key=str) == sorted(
        [(k, e) for k in (None, -1) for e in (1, 2, 3)], key=str)
    assert left(spark, ckpt, "until") == 0
    only = df.filter("is_row = 1")
    out, ckpt = replay(only, epoch_millis("ts"), lambda s: expiring_jump_stream(instant(s), 10 * 10**6, 1.7), "ttl", flush_time="ts")
    assert sorted(((r["sensor_id"], r["event_id"]) for r in out.collect()), key=str) == sorted(
        [(k, e) for k in (None, -1) for e in (2, 3, 6)], key=str)
    assert left(spark, ckpt, "last") == 0
