"""Pieces of a window give what all its rows in order give."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from riverbed.operators.whole import RISE_PIECE, rise_of_piece, rise_of_pieces, whole_window
from riverbed.plans.stream_state import hourly_tips_slow_rules
from tests.conftest import SF_SMALL

RESULT = "n_rows long, longest_rise long, climb double"


def plain(values):
    run = best = 0
    climb, prev = 0.0, None
    for v in values:
        run = run + 1 if prev is not None and v > prev else 1
        climb += v - prev if prev is not None and v > prev else 0
        best, prev = max(best, run), v
    return len(values), best, round(climb, 6)


@pytest.mark.parametrize("rows", [3, 40, 10_000])
def test_pieces(spark, rows):
    """One key holds nine rows of ten; one of its stretches rises over many pieces."""
    rng = random.Random(rows)
    start = datetime(2024, 1, 1)
    data = [(None if k == 2 else k, start + timedelta(seconds=i // 2), i, float(i) if 100 < i < 160 else float(rng.randrange(6)))
            for i in range(400) for k in [0 if rng.random() < 0.9 else rng.randrange(1, 4)]]
    df = spark.createDataFrame(data, "k long, ts timestamp_ntz, i long, temp double")
    got = whole_window(df, ["k"], "ts", ["i"], rise_of_piece, RISE_PIECE, rise_of_pieces, RESULT, rows).collect()
    want = {k: plain([d[3] for d in data if d[0] == k]) for k in {d[0] for d in data}}
    assert {r.k: (r.n_rows, r.longest_rise, round(r.climb, 6)) for r in got} == want
    if rows == 3:
        most = df.withColumn("p", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_500_000)).groupBy("k", "p").count()
        assert most.agg(F.max("count")).first()[0] <= 4


def test_min_policy_holds_back(spark):
    """With the policy ``min`` the slow rules keep the last two days' windows open."""
    fares = {p: hourly_tips_slow_rules(spark, SF_SMALL, p).filter("kind = 'fare'") for p in ("max", "min")}
    top = {p: d.agg(F.max("at"), F.count("*")).first() for p, d in fares.items()}
    assert 0 < top["min"][1] < top["max"][1]
    assert top["max"][0] - top["min"][0] > timedelta(hours=40)
