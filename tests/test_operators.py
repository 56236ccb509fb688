"""Chunked (skew-safe) operators against brute force on random data.

One key holds most rows and the chunks are small, so every carry-in path
across chunk boundaries is exercised."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from riverbed.operators.joins import asof_join, band_join
from riverbed.operators.running import previous_value, running_max_before, running_sum, running_sums_before

BASE = datetime(2024, 1, 1)


def _data(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.7, 0, rng.integers(1, 5, n))          # key 0: the hot key
    rows = [(int(i), int(k), int(rng.integers(0, 5000)), float(rng.integers(-50, 50)))
            for i, k in enumerate(key)]
    pdf = pd.DataFrame(rows, columns=["id", "k", "t", "v"])
    return spark.createDataFrame(pdf), pdf


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_running_sum_matches_cumsum(spark):
    df, pdf = _data(spark)
    got = _rows(running_sum(df, ["k"], ["t", "id"], F.floor(F.col("t") / 250), F.col("v"), "s"), ["id", "s"])
    p = pdf.sort_values(["k", "t", "id"])
    p["s"] = p.groupby("k")["v"].cumsum()
    assert got == sorted(zip(p["id"], p["s"]))


def test_keyless_running_sum_matches_cumsum(spark):
    df, pdf = _data(spark, seed=2)
    got = _rows(running_sum(df, [], ["t", "id"], F.floor(F.col("t") / 300), F.col("v"), "s"), ["id", "s"])
    p = pdf.sort_values(["t", "id"])
    assert got == sorted(zip(p["id"], p["v"].cumsum()))


def test_previous_value_matches_shift(spark):
    df, pdf = _data(spark, seed=3)
    got = _rows(previous_value(df, ["k"], ["t", "id"], F.floor(F.col("t") / 200), F.col("v"), "p"), ["id", "p"])
    p = pdf.sort_values(["k", "t", "id"])
    p["p"] = p.groupby("k")["v"].shift(1)
    want = sorted((i, None if pd.isna(x) else x) for i, x in zip(p["id"], p["p"]))
    assert got == want


def test_running_max_before_matches_expanding(spark):
    df, pdf = _data(spark, seed=4)
    got = _rows(running_max_before(df, [], ["t", "id"], F.floor(F.col("t") / 400), F.col("v"), "m"), ["id", "m"])
    p = pdf.sort_values(["t", "id"])
    prev = p["v"].cummax().shift(1)
    want = sorted((i, None if pd.isna(x) else x) for i, x in zip(p["id"], prev))
    assert got == want


def test_running_sums_before_matches_exclusive_cumsum(spark):
    df, pdf = _data(spark, seed=5)
    got = _rows(running_sums_before(df, ["k"], ["t", "id"], F.floor(F.col("t") / 250),
                                    {"a": F.col("v"), "b": F.col("v") * 2}), ["id", "a", "b"])
    p = pdf.sort_values(["k", "t", "id"])
    a = p.groupby("k")["v"].cumsum() - p["v"]
    assert got == sorted(zip(p["id"], a, 2 * a))


def test_asof_join_matches_brute_force(spark):
    rng = np.random.default_rng(6)
    left = [(i, int(rng.integers(0, 3)), BASE + timedelta(minutes=int(rng.integers(0, 6000)))) for i in range(150)]
    right = [(int(rng.integers(0, 3)), BASE + timedelta(minutes=int(rng.integers(0, 6000))), f"r{j}") for j in range(200)]
    l_df = spark.createDataFrame(left, "lid long, k long, lt timestamp_ntz")
    r_df = spark.createDataFrame(right, "k long, rt timestamp_ntz, info string")
    got = _rows(asof_join(l_df, r_df, ["k"], "lt", "rt", ["info"]), ["lid", "info"])
    want = []
    for lid, k, lt in left:
        cands = [(rt, info) for rk, rt, info in right if rk == k and rt <= lt]
        want.append((lid, max(cands)[1] if cands else None))
    assert got == sorted(want, key=lambda x: (x[0], x[1] or ""))


def test_band_join_inner_semi_anti(spark):
    rng = np.random.default_rng(7)
    left = [(i, int(rng.integers(0, 2)), BASE + timedelta(seconds=int(rng.integers(0, 20000)))) for i in range(120)]
    right = [(int(rng.integers(0, 2)), BASE + timedelta(seconds=int(rng.integers(0, 20000))), j) for j in range(160)]
    l_df = spark.createDataFrame(left, "lid long, k long, lt timestamp_ntz")
    r_df = spark.createDataFrame(right, "k long, rt timestamp_ntz, rid long")
    lo, hi = -600_000, 300_000
    pairs = {(lid, rid) for lid, k, lt in left for rk, rt, rid in right
             if rk == k and lo <= (rt - lt).total_seconds() * 1000 <= hi}
    got = set(_rows(band_join(l_df, r_df, ["k"], "lt", "rt", lo, hi), ["lid", "rid"]))
    assert got == pairs
    matched = {lid for lid, _ in pairs}
    assert {r[0] for r in _rows(band_join(l_df, r_df, ["k"], "lt", "rt", lo, hi, "left_semi", "lid"), ["lid"])} == matched
    assert {r[0] for r in _rows(band_join(l_df, r_df, ["k"], "lt", "rt", lo, hi, "left_anti", "lid"), ["lid"])} == \
        {lid for lid, _, _ in left} - matched


def test_gap_sessions_matches_brute_force(spark):
    from riverbed.operators.running import gap_sessions
    rng = np.random.default_rng(8)
    rows = [(i, int(k), BASE + timedelta(minutes=int(rng.integers(0, 4000))))
            for i, k in enumerate(np.where(rng.random(300) < 0.7, 0, rng.integers(1, 4, 300)))]
    df = spark.createDataFrame(rows, "id long, k long, t timestamp_ntz")
    gap_ms = 30 * 60 * 1000
    got = _rows(gap_sessions(df, ["k"], ["t", "id"], "t", F.date_trunc("hour", "t"), gap_ms), ["id", "session"])
    want = []
    for k in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == k), key=lambda r: (r[2], r[0]))
        sess, last = 0, None
        for i, _, t in mine:
            if last is None or (t - last).total_seconds() * 1000 > gap_ms:
                sess += 1
            want.append((i, sess))
            last = t
    assert got == sorted(want)


def test_null_keys_and_times_keep_their_rows(spark):
    from pyspark.sql import functions as F

    from riverbed.operators import joins, running
    rows = [("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 4.0), (None, 2, 8.0), ("b", None, 16.0)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    chunk = F.floor(F.col("t") / 2)
    got = running.running_sum(df, ["k"], ["t"], chunk, F.col("v"), "s").collect()
    assert sorted((r["v"], r["s"]) for r in got) == [(1, 1), (2, 3), (4, 4), (8, 12), (16, 16)]
    got = running.previous_value(df, ["k"], ["t"], chunk, F.col("v"), "p").collect()
    assert sorted((r["v"], r["p"]) for r in got) == [(1, None), (2, 1), (4, None), (8, 4), (16, None)]
    right = df.select("k", F.col("t").alias("rt"), F.col("v").alias("w"))
    got = joins.asof_join(df, right, ["k"], "t", "rt", ["w"], chunk_fn=lambda t: F.floor(t / 2)).collect()
    assert sorted((r["v"], r["w"]) for r in got) == [(1, 1), (2, 2), (4, None), (8, None), (16, None)]
