"""Nearest-so-far search against all pairs, with bursts in time, hot places, ties and resets."""

import random

import pytest

from riverbed.operators import nearest
from riverbed.plans.geo_places import open_until_cleanup

Q = "query_id long, lon double, lat double, from_us long, upto_us long"
P = "ride_id long, taxi_id long, us long, lon double, lat double"


def far(q, p):
    import math
    dy, dx = q[2] - p[4], (q[1] - p[3]) * math.cos(p[4])
    return 110.25 * math.sqrt(dy * dy + dx * dx)


def plain(qs, ps, retention=None):
    out = set()
    for q in qs:
        best = since = None
        for p in sorted((p for p in ps if None not in p[2:]), key=lambda p: (p[2], p[0])):
            if None in q or not q[3] <= p[2] <= q[4]:
                continue
            if best is not None and retention is not None and p[2] > since + retention:
                best = None
            if best is None or far(q, p) < best:
                best, since = far(q, p), p[2]
                out.add((q[0], p[0]))
    return out


def rows(rng, n_points, n_queries, hot):
    place = lambda: (rng.uniform(-74.05, -73.7), rng.uniform(40.5, 41.0))
    ps = []
    for i in range(n_points):
        lon, lat = (-73.9, 40.7) if rng.random() < hot else place()
        ps.append((i, i % 7, rng.choice([500, rng.randrange(1000)]), lon, lat))
    qs = [(i, *(place() if i % 5 else (-73.9, 40.7)), s := rng.randrange(-50, 900), s + rng.choice([0, 30, 400, 2000])) for i in range(n_queries)]
    return qs, ps


@pytest.mark.parametrize("seed,hot", [(1, 0.0), (2, 0.4), (3, 1.0)])
def test_all_pairs(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(nearest, "FIRST", 16)  # several rounds on few rows
    qs, ps = rows(random.Random(seed), 600, 60, hot)
    qs += [(100, None, 40.7, 0, 1000), (101, -73.9, 40.7, None, 1000)]
    ps += [(1000, 1, 10, None, 40.7), (1001, 1, None, -73.9, 40.7)]
    found = nearest.nearest_so_far(spark.createDataFrame(qs, Q), spark.createDataFrame(ps, P), "query_id", "ride_id").collect()
    assert {(r.query_id, r.ride_id) for r in found} == plain(qs, ps)
    assert len(found) == len(plain(qs, ps))
    by_id = {q[0]: q for q in qs}, {p[0]: p for p in ps}
    assert all(abs(r.distance - far(by_id[0][r.query_id], by_id[1][r.ride_id])) < 1e-9 for r in found)


def test_comparisons_stay_few(spark, monkeypatch):
    """With points in no order, a query's candidates past its first block don't follow its span."""
    counts = []
    write = nearest.materialize

    def counting(df, name):
        out = write(df, name)
        if name == "nearest-found":
            counts.append(out.count())
        return out
    monkeypatch.setattr(nearest, "materialize", counting)
    rng = random.Random(5)
    ps = [(i, 1, i, rng.uniform(-74.05, -73.7), rng.uniform(40.5, 41.0)) for i in range(4000)]
    qs = [(i, rng.uniform(-74.05, -73.7), rng.uniform(40.5, 41.0), i * 10, 4000) for i in range(100)]
    n = nearest.nearest_so_far(spark.createDataFrame(qs, Q), spark.createDataFrame(ps, P), "query_id", "ride_id").count()
    assert n == len(plain(qs, ps))
    assert sum(counts) < 20 * len(qs)


def test_reset(spark, monkeypatch):
    monkeypatch.setattr(nearest, "FIRST", 4)
    qs, ps = rows(random.Random(9), 200, 25, 0.3)
    found = nearest.nearest_with_reset(spark.createDataFrame(qs, Q), spark.createDataFrame(ps, P), "query_id", "ride_id", 500).collect()
    got = [(r.query_id, r.ride_id) for r in found]
    assert len(got) == len(set(got)) and set(got) == plain(qs, ps, 500)
    assert len(got) > len(plain(qs, ps))


def test_later_generations_read_what_is_still_seen(spark, monkeypatch):
    """One query of 40 outlives its best; its next search orders the points of its span, not all."""
    sizes = []
    write = nearest.materialize

    def counting(df, name):
        out = write(df, name)
        if name == "nearest-order":
            sizes.append(out.filter("kind = 1").count())
        return out
    monkeypatch.setattr(nearest, "materialize", counting)
    ps = [(i, 1, 10 * i if i < 1000 else 100_000 + i, -74.0 + i % 7 / 100, 40.7) for i in range(2000)]
    qs = [(i, -73.9, 40.6, 10 * i, 10 * i + 300) for i in range(39)] + [(100, -73.9, 40.6, 9_000, 100_050 + 1000)]
    found = nearest.nearest_with_reset(spark.createDataFrame(qs, Q), spark.createDataFrame(ps, P), "query_id", "ride_id", 50_000).collect()
    got = [(r.query_id, r.ride_id) for r in found]
    assert len(got) == len(set(got)) and set(got) == plain(qs, ps, 50_000)
    assert sizes[0] == len(ps) and len(sizes) > 1
    qs = [(i, -73.9, 40.6, 10 * i, 10 * i + 300) for i in range(39)] + [(100, -73.9, 40.6, 0, 9_000)]
    sizes.clear()
    found = nearest.nearest_with_reset(spark.createDataFrame(qs, Q), spark.createDataFrame(ps, P), "query_id", "ride_id", 5_000).collect()
    assert {(r.query_id, r.ride_id) for r in found} == plain(qs, ps, 5_000)
    assert sizes[0] == len(ps) and all(0 < n < len(ps) // 3 for n in sizes[1:]) and len(sizes) > 1


def test_rounds_follow_the_span_slowly(spark, monkeypatch):
    """A span of 4,000 points is asked in at most five searches, each of which reads all points."""
    searches = []
    write = nearest.materialize
    monkeypatch.setattr(nearest, "materialize", lambda df, name: searches.append(name) or write(df, name))
    rng = random.Random(6)
    ps = [(i, 1, i, rng.uniform(-74.05, -73.7), rng.uniform(40.5, 41.0)) for i in range(4000)]
    qs = [(i, rng.uniform(-74.05, -73.7), rng.uniform(40.5, 41.0), i, 4000) for i in range(50)]
    found = nearest.nearest_so_far(spark.createDataFrame(qs, Q), spark.createDataFrame(ps, P), "query_id", "ride_id").collect()
    assert {(r.query_id, r.ride_id) for r in found} == plain(qs, ps)
    assert searches.count("nearest-found") <= 5


def test_empty(spark):
    qs, ps = rows(random.Random(1), 20, 3, 0.0)
    for a, b in (([], ps), (qs, []), ([], [])):
        args = spark.createDataFrame(a, Q), spark.createDataFrame(b, P), "query_id", "ride_id"
        assert nearest.nearest_so_far(*args).count() == 0
        assert nearest.nearest_with_reset(*args, 60).count() == 0


def test_open_until_cleanup(spark):
    """A request goes with the first one over its life later, which may only clean up."""
    r = [(1, 5.0, 1.0, 0), (2, 0.0, 1.0, 100), (3, 5.0, 1.0, 101), (4, 0.0, 1.0, 205)]
    p = spark.createDataFrame([(1, 1, 300, 5.0, 1.0)], P)
    out = open_until_cleanup(spark.createDataFrame(r, "query_id long, lon double, lat double, from_us long"), p, 100).collect()
    assert {x.query_id: x.upto_us for x in out} == {1: 100, 3: 204}
    alone = open_until_cleanup(spark.createDataFrame(r[:1], "query_id long, lon double, lat double, from_us long"), p, 100).collect()
    assert alone[0].upto_us == 300
