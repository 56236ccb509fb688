"""Micro-batches follow the rows, and a call of Python is for many keys."""

import datetime as dt
import os

from pyspark.sql import functions as F

from riverbed.functions.time import to_instant
from riverbed.operators.whole import RISE_PIECE, rise_of_piece, rise_of_pieces, whole_window
from riverbed.plans import alerts
from riverbed.streaming import replay as replays
from riverbed.streaming.files import files_per_trigger, stage_files
from riverbed.streaming.keyed_state import BUCKETS, retry_join_stream, threshold_stream
from riverbed.streaming.replay import by_volume, replay, state

T0 = dt.datetime(2024, 1, 1)


def test_batches_do_not_follow_splits(spark, monkeypatch):
    df = spark.range(0, 1000, 1, 40).select(F.col("id").alias("t"))
    batches = lambda: df.select(by_volume(df, F.col("t")).alias("b")).distinct().count()
    assert batches() == 4
    monkeypatch.setattr(replays, "BATCH_ROWS", 100)
    assert batches() == 10


def test_a_batch_takes_many_files(spark, tmp_path):
    df = spark.range(0, 1000, 1, 40).select(F.timestamp_micros(F.col("id") * 10**6).alias("ts"))
    files = stage_files(df, str(tmp_path / "src"), "ts", 4)
    assert len(files) >= 30 and files_per_trigger(spark, files, 4) == len(files) // 4
    assert files_per_trigger(spark, files[:3], 4) == 1


def test_state_is_held_by_buckets_and_ids_stay_exact(spark):
    """Long ids keep their last digit beside a null key; 1500 keys take no more rows of state than there are buckets."""
    big = 2**60 + 1
    keys = [None, big, big + 1, *range(1500)]
    rows = [(k, t, 1, t, v) for k in keys for t, v in ((1, 10.0), (2, 100.0 if k is None or k >= big else 11.0))]
    df = spark.createDataFrame(rows, "sensor_id long, ts_us long, is_row int, seq long, value double")
    out, ckpt = replay(df, F.col("ts_us"), lambda s: threshold_stream(s, alerts.DEFAULT_THRESHOLD), "buckets")
    assert {(r["sensor_id"], r["event_id"]) for r in out.collect()} == {(None, 2), (big, 2), (big + 1, 2)}
    held = state(spark, ckpt, "last")
    assert held.count() <= BUCKETS < len(keys)


def test_small_windows_share_a_batch(spark):
    """Groups that end inside an Arrow batch and groups that go on over many of them; long ids beside a null one."""
    big = 2**60 + 1
    data = [(k, T0 + dt.timedelta(seconds=i), i, float(i % n)) for k, n, rows in
            [(None, 3, 10), (big, 4, 25), (big + 1, 50, 50), *((k, 2, 2) for k in range(40))] for i in range(rows)]
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, i long, temp double")
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, 7)
    try:
        out = whole_window(df, ["k"], "ts", ["i"], rise_of_piece, RISE_PIECE, rise_of_pieces, "n_rows long, longest_rise long, climb double", 30)
        got = {r.k: (r.n_rows, r.longest_rise) for r in out.collect()}
    finally:
        spark.conf.set(conf, before)
    assert got == {None: (10, 3), big: (25, 4), big + 1: (50, 50), **{k: (2, 2) for k in range(40)}}
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()


def test_a_trade_that_comes_twice_waits_once(spark):
    rows = [(0, 1, 2, True, 10), (0, 1, 2, True, 10), (1, 2, 9, True, 30)]
    df = spark.createDataFrame([(b, c, T0 + dt.timedelta(seconds=t), i, i, x, None) for b, i, c, x, t in rows],
                               "b int, customer_id long, ts timestamp_ntz, arrival_ms long, event_id long, is_trade boolean, info string")
    out, _ = replay(df, F.col("b"), lambda s: retry_join_stream(s.withColumn("ts", to_instant("ts")), "5 seconds"), "twice", flush_time="ts")
    assert sorted((r["trade_id"], r["answered"]) for r in out.collect()) == [(1, "waited"), (2, "waited")]


def test_state_partitions_follow_rows_and_cores(spark, monkeypatch):
    conf, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(4 * cores))
    df = spark.range(0, 1000).select("id", (F.col("id") % 7).alias("key"))
    parts = lambda ckpt: spark.read.format("state-metadata").load(ckpt).first()["numPartitions"]
    try:
        for rows, want in ((10**6, cores), (-(-1000 // (2 * cores)), 2 * cores), (1, 4 * cores)):
            monkeypatch.setattr(replays, "STATE_ROWS", rows)
            _, ckpt = replay(df, F.col("id") % 2, lambda s: s.groupBy("key").agg(F.max("id").alias("top")), "parts", mode="update")
            assert parts(ckpt) == want and spark.conf.get(conf) == str(4 * cores)
            assert state(spark, ckpt).count() == 7
    finally:
        spark.conf.set(conf, before)


def test_windows_close_without_idle_batches(spark):
    """Rows in the order of their time: the same counts from fewer batches."""
    df = spark.createDataFrame([(b, k, T0 + dt.timedelta(seconds=s)) for b, k, s in
                                [(0, 1, 1), (0, None, 2), (0, 1, 30), (1, 1, 30), (1, 1, 31), (1, None, 60), (2, 1, 60), (2, 1, 71)]],
                               "b int, key long, ts timestamp_ntz")
    count = lambda s: (s.withColumn("ts", to_instant("ts")).withWatermark("ts", "5 seconds")
                       .groupBy(F.window("ts", "10 seconds"), "key", replays.FLUSH).agg(F.count("*").alias("n")))
    rows, commits = {}, {}
    for idle in (True, False):
        out, ckpt = replay(df, F.col("b"), count, "idle", flush_time="ts", idle_batches=idle)
        rows[idle] = sorted(((r["window"]["start"], r["key"], r["n"]) for r in out.collect()), key=str)
        commits[idle] = sum(f.isdigit() for f in os.listdir(os.path.join(ckpt, "commits")))
    assert rows[True] == rows[False] and len(rows[True]) == 6
    assert commits[False] == 5 < commits[True]
