"""Null and -1 keys survive: streams closed by a flush row, and batch operators that join back on a key."""

import datetime as dt

from pyspark.sql import functions as F

from riverbed.plans import alerts, cars_patterns, heartbeats, stream_io, stream_plans
from riverbed.sources import views

T0 = dt.datetime(2024, 1, 1)
#: Event 1 and 2 have users that the views turn into null and -1 keys.
EVENTS = [(i, None if i % 3 == 0 else -1 if i % 3 == 1 else 7, T0 + dt.timedelta(minutes=7 * i), float(60 + 9 * (i % 5)), "click")
          for i in range(1, 40)]


def events(spark, folder):
    df = spark.createDataFrame(EVENTS, "event_id long, user_id long, ts timestamp_ntz, value double, event_type string")
    df.write.parquet(f"{folder}/events.parquet")
    return str(folder)


def keys(df, column):
    return {r[0] for r in df.select(column).distinct().collect()}


def test_streams_keep_every_key(spark, tmp_path):
    d = events(spark, tmp_path)
    fares = views.fares(spark, d)
    for query in (stream_plans.hourly_tips_stream, stream_io.restart_resume):
        out = query(spark, d)
        assert keys(out, "driver_id") == keys(fares, "driver_id") == {None, -1, 7}
        total = out.agg(F.round(F.sum("total_tips"), 6)).first()[0]
        assert total == fares.agg(F.round(F.sum("tip"), 6)).first()[0]
    assert stream_io.transactional_file_sink(spark, d).count() == len(EVENTS)


def test_long_ride_streams_keep_minus_one_and_null_rides(spark, tmp_path):
    df = spark.createDataFrame([(i, 1, T0 + dt.timedelta(minutes=i or 0), 60.0, "click") for i in (None, -1, 50, 60)],
                               "event_id long, user_id long, ts timestamp_ntz, value double, event_type string")
    df.write.parquet(f"{tmp_path}/events.parquet")
    r = views.rides(spark, str(tmp_path))
    starts = r.filter("is_start")
    assert keys(starts, "ride_id") == {-1, 50, 60}
    for query in (stream_plans.long_rides_stream_query, stream_plans.cep_long_rides_stream):
        assert keys(query(spark, str(tmp_path)), "ride_id") == {-1, 50, 60}


def test_null_cars_products_and_sensors(spark):
    rows = [(k, i, T0 + dt.timedelta(minutes=i), float(v)) for k in (None, 3) for i, v in enumerate([0, 5, 6, 0, 7, 0, 8])]
    cars = spark.createDataFrame(rows, "car_id long, id long, event_time timestamp_ntz, speed double").withColumn("throttle", F.col("id"))
    for least, lengths in ((0, [1, 2]), (1, [1, 2])):
        out = cars_patterns.closed_segments(cars, least)
        for key in ("car_id is null", "car_id = 3"):
            assert sorted(r["length"] for r in out.filter(key).collect()) == lengths
    beats = spark.createDataFrame([(1, p, 1, e, T0 + dt.timedelta(seconds=e)) for p in (None, "a") for e in (0, 4, 9, 30)],
                                  "instance_id long, product_id string, customer_id long, event_id long, ts timestamp_ntz")
    out = heartbeats.product_periods(heartbeats.instance_sessions_df(beats))
    assert sorted(((r["product_id"], r["total_session_s"]) for r in out.collect()), key=str) == sorted(
        [(p, s) for p in (None, "a") for s in (9, 21)], key=str)
    readings = spark.createDataFrame([(e, k, T0 + dt.timedelta(seconds=e), float(t)) for k in (None, 2) for e, t in
                                      enumerate([1, 2, 1, 5, 6, 7])], "event_id long, sensor_id long, ts timestamp_ntz, temp double")
    out = alerts.rising_runs(readings)
    # the first rise falls back a second later, the second lasts
    assert sorted(((r["sensor_id"], r["rise_ts"]) for r in out.collect()), key=str) == sorted(
        [(k, T0 + dt.timedelta(seconds=3)) for k in (None, 2)], key=str)
