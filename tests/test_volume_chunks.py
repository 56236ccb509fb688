"""Chunks cut by volume: bursts, hot keys, nulls, ties; counts over RANGE frames against brute force."""

from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros
from riverbed.operators import running
from riverbed.operators.joins import asof_join
from riverbed.operators.running import previous_value, range_count, running_sum, volume_chunk

BASE = datetime(2024, 1, 1)
SCHEMA = "id long, k string, ts timestamp_ntz"


def bursty(n=3000, seed=1):
    """Nine rows in ten lie within one second of a month and belong to one key."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.9
        us = int(rng.integers(0, 1_000_000)) + 10 ** 12 if hot else int(rng.integers(0, 30 * 86400)) * 10 ** 6
        rows.append((i, "hot" if hot else ["a", "b", None][int(rng.integers(0, 3))], BASE + timedelta(microseconds=us)))
    return rows


def test_chunks_hold_alike_many_rows_in_a_burst(spark):
    df = spark.createDataFrame(bursty(), SCHEMA)
    sizes = {r.c: r["count"] for r in df.groupBy(volume_chunk(df, epoch_micros("ts"), 100).alias("c")).count().collect()}
    assert sorted(sizes) == list(range(30)) and max(sizes.values()) < 3 * 100
    most = df.groupBy("k", volume_chunk(df, epoch_micros("ts"), 100).alias("c")).count().agg(F.max("count")).first()[0]
    assert most < 3 * 100


def test_chunks_rise_with_the_value(spark):
    rng = np.random.default_rng(3)
    values = [int(v) for v in rng.integers(-2 ** 40, 2 ** 40, 500)] + [-2 ** 62, 2 ** 62, 0, 0, 0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    for rows in (1, 7, 100, 10 ** 6):
        got = df.select("v", volume_chunk(df, F.col("v"), rows).alias("c")).collect()
        assert [r.c for r in got if r.v is None] == [None]
        chunks = [c for _, c in sorted((r.v, r.c) for r in got if r.v is not None)]
        assert chunks == sorted(chunks) and chunks[0] == 0
        assert all(len({r.c for r in got if r.v == v}) == 1 for v in (0,))
    assert max(chunks) == 0  # the last size holds all rows


def test_chunk_of_no_rows_and_of_one_value(spark):
    none = spark.createDataFrame([], "v long")
    assert none.select(volume_chunk(none, F.col("v")).alias("c")).collect() == []
    same = spark.createDataFrame([(5,)] * 50, "v long")
    assert len({r.c for r in same.select(volume_chunk(same, F.col("v"), 3).alias("c")).collect()}) == 1


def brute(rows, width):
    def inside(a, b):
        if a is None or b is None:
            return a is b
        return a - width <= b <= a
    by_key = {}
    for _, k, t in rows:
        by_key.setdefault(k, []).append(t)
    return {i: sum(inside(t, u) for u in by_key[k]) for i, k, t in rows}


@pytest.mark.parametrize("chunk", [1, 40, 10 ** 6])
def test_range_count(spark, chunk):
    """Ties, rows exactly at the frame's start, null times and null keys, a frame over many chunks."""
    rng = np.random.default_rng(5)
    rows = [(i, ["x", "y", None][int(min(2, rng.integers(0, 8)))], None if rng.random() < 0.03 else BASE + timedelta(seconds=int(rng.integers(0, 900))))
            for i in range(400)]
    got = range_count(spark.createDataFrame(rows, SCHEMA), ["k"], "ts", 60_000_000, "cnt", rows=chunk)
    assert {r.id: r.cnt for r in got.collect()} == brute(rows, timedelta(seconds=60))


def test_range_count_of_a_burst(spark):
    """A frame of ten minutes holds the whole burst; the widest window partition stays a chunk."""
    rows = bursty(1500, seed=9)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: r.cnt for r in range_count(df, ["k"], "ts", 600_000_000, "cnt", rows=64).collect()}
    assert got == brute(rows, timedelta(minutes=10))


def test_range_count_without_rows_keys_or_with_other_columns(spark):
    assert range_count(spark.createDataFrame([], SCHEMA), ["k"], "ts", 10, "cnt").collect() == []
    rows = bursty(200, seed=4)
    all_ = range_count(spark.createDataFrame(rows, SCHEMA), [], "ts", 1000, "cnt", rows=16)
    assert {r.id: r.cnt for r in all_.collect()} == brute([(i, 0, t) for i, _, t in rows], timedelta(milliseconds=1))
    twice = spark.createDataFrame(rows + rows, SCHEMA).withColumn("extra", F.lit("x"))
    got = range_count(twice, ["k"], "ts", 1000, "cnt", rows=16)
    assert got.columns == ["id", "k", "ts", "extra", "cnt"] and got.count() == 400


def test_running_operators_over_burst_chunks(spark):
    rows = bursty(1200, seed=2)
    df = spark.createDataFrame(rows, SCHEMA)
    chunk = volume_chunk(df, epoch_micros("ts"), 50)
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    seen, want, last, prev = Counter(), {}, {}, {}
    for i, k, _ in order:
        seen[k] += 1
        want[i], prev[i], last[k] = seen[k], last.get(k), i
    got = running_sum(df, ["k"], ["ts", "id"], chunk, F.lit(1).cast("long"), "n")
    assert {r.id: r.n for r in got.collect()} == want
    got = previous_value(df, ["k"], ["ts", "id"], chunk, F.col("id"), "p")
    assert {r.id: r.p for r in got.collect()} == prev


def test_asof_join_cuts_by_volume(spark, monkeypatch):
    monkeypatch.setattr(running, "CHUNK_ROWS", 20)
    monkeypatch.setattr(running.volume_chunk, "__defaults__", (20,))
    rows = bursty(300, seed=7)
    left, right = rows[:150], [(i, k, t) for i, k, t in rows[150:]]
    l_df = spark.createDataFrame(left, "lid long, k string, lt timestamp_ntz")
    r_df = spark.createDataFrame(right, "rid long, k string, rt timestamp_ntz")
    want = {}
    for i, k, t in left:
        best = max(((u, j) for j, k2, u in right if k2 is not None and k2 == k and u <= t), default=(None, None))
        want[i] = best[1]
    for keys, expected in ((["k"], want),):
        got = asof_join(l_df, r_df, keys, "lt", "rt", ["rid"])
        assert {r.lid: r.rid for r in got.collect()} == expected
    by_number = asof_join(l_df.withColumn("ln", F.col("lid") * 3), r_df.drop("k").withColumn("rn", F.col("rid")), [], "ln", "rn", ["rid"])
    ids = sorted(j for j, _, _ in right)
    assert {r.lid: r.rid for r in by_number.collect()} == {i: max((j for j in ids if j <= 3 * i), default=None) for i, _, _ in left}
