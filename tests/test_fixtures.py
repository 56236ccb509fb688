"""Literal cases from the reference's tests (FIXTURES.md §A), run through the
library operators on tiny DataFrames."""

from datetime import datetime, timedelta

import numpy as np
from pyspark.sql import functions as F

from riverbed.functions import geo
from riverbed.operators.joins import asof_join
from riverbed.plans.geo_places import cleansed, popular_places_df
from riverbed.plans.ride_state import enriched, long_rides_df
from riverbed.plans.tips import hourly_tips_max_df

P = (-73.9947, 40.750626)   # Penn Station
N = (0.0, 90.0)             # outside the city
M = (-73.9776, 40.7614)
T0 = datetime(2020, 1, 1, 12, 0, 0)
RIDE_COLS = ["ride_id", "is_start", "event_time", "start_time", "end_time", "start_lon", "start_lat",
             "end_lon", "end_lat", "passenger_cnt", "taxi_id", "driver_id"]


def ride(rid, is_start, start, end, a=P, b=P, taxi=1):
    ev = start if is_start else end
    return (rid, is_start, ev, start, end, float(a[0]), float(a[1]), float(b[0]), float(b[1]), 1, taxi, 1)


def rides_df(spark, rows):
    return spark.createDataFrame(rows, "ride_id long, is_start boolean, event_time timestamp_ntz, "
                                       "start_time timestamp_ntz, end_time timestamp_ntz, start_lon double, "
                                       "start_lat double, end_lon double, end_lat double, passenger_cnt long, "
                                       "taxi_id long, driver_id long")


def test_penn_station_cell_and_centre(spark):
    df = spark.createDataFrame([(P[0], P[1])], "lon float, lat float")
    r = df.select(geo.grid_cell("lon", "lat").alias("cell")).select(
        "cell", geo.cell_center_lon("cell").alias("lon"), geo.cell_center_lat("cell").alias("lat")).first()
    assert r.cell == 49789
    assert np.float32(r.lon) == np.float32(P[0]) and np.float32(r.lat) == np.float32(P[1])


def test_cleansing_keeps_only_inside_rides(spark):
    rows = [ride(1, True, T0, None, P, P), ride(2, True, T0, None, P, N),
            ride(3, True, T0, None, N, P), ride(4, True, T0, None, N, N)]
    assert [r.ride_id for r in cleansed(rides_df(spark, rows)).collect()] == [1]


def test_long_rides_cases(spark):
    h = timedelta(hours=1)
    short = [ride(1, True, T0, None), ride(1, False, T0, T0 + timedelta(minutes=1))]
    end_only = [ride(2, False, T0, T0 + timedelta(minutes=1))]
    no_end = [ride(3, True, T0, None)]
    late_end = [ride(4, True, T0, None), ride(4, False, T0, T0 + 3 * h)]
    out = long_rides_df(rides_df(spark, short + end_only + no_end + late_end))
    assert sorted(r.ride_id for r in out.collect()) == [3, 4]


def test_rides_and_fares_pairs(spark):
    rows = [ride(1, True, T0, None), ride(2, True, T0, None)]
    fares = spark.createDataFrame([(1, 1, 1, T0, "CSH", 1.0, 0.0, 10.0), (2, 1, 1, T0, "CRD", 2.0, 0.0, 20.0)],
                                  "ride_id long, taxi_id long, driver_id long, start_time timestamp_ntz, "
                                  "payment_type string, tip double, tolls double, total_fare double")
    got = sorted((r.ride_id, r.tip) for r in enriched(rides_df(spark, rows), fares).collect())
    assert got == [(1, 1.0), (2, 2.0)]


def _asof(spark, customers, trades):
    c = spark.createDataFrame([(1, datetime.fromtimestamp(t / 1000), f"c{t}") for t in customers],
                              "customer_id long, cust_ts timestamp_ntz, customer_info string")
    t = spark.createDataFrame([(t, 1, datetime.fromtimestamp(t / 1000)) for t in trades],
                              "trade_id long, customer_id long, trade_ts timestamp_ntz")
    return sorted((r.trade_id, r.customer_info) for r in
                  asof_join(t, c, ["customer_id"], "trade_ts", "cust_ts", ["customer_info"]).collect())


def test_asof_cases(spark):
    assert _asof(spark, [0, 500, 1500], [1000]) == [(1000, "c500")]
    assert _asof(spark, [500, 1500], [1200, 1500]) == [(1200, "c500"), (1500, "c1500")]
    assert _asof(spark, [1600, 2100], [1700, 1800, 2000]) == [(1700, "c1600"), (1800, "c1600"), (2000, "c1600")]


def test_hourly_tips_max(spark):
    rows = [(1, T0.replace(hour=0, minute=0), 1.0), (1, T0.replace(hour=0, minute=15), 5.0),
            (1, T0.replace(hour=1, minute=30), 10.0), (2, T0.replace(hour=1, minute=30), 20.0)]
    fares = spark.createDataFrame(rows, "driver_id long, start_time timestamp_ntz, tip double")
    got = sorted((r.window_end.hour, r.driver_id, r.total_tips) for r in hourly_tips_max_df(fares).collect())
    assert got == [(1, 1, 6.0), (2, 2, 20.0)]


def test_popular_places_threshold_two(spark):
    start = datetime(2020, 1, 1, 0, 0)
    rows = [ride(i, True, start + timedelta(minutes=m), None, P, M) for i, m in ((1, 0), (2, 6), (3, 14))]
    rows += [ride(10 + i, False, start, start + timedelta(minutes=15), P, M) for i in range(3)]
    got = sorted((r.is_start, r.window_end.minute if r.window_end.hour == 0 else 60 + r.window_end.minute, r.cnt)
                 for r in popular_places_df(rides_df(spark, rows), 2).collect())
    assert got == [(False, 20, 3), (False, 25, 3), (False, 30, 3), (True, 10, 2), (True, 15, 3), (True, 20, 2)]


def test_distance_predicate_near_m(spark):
    df = spark.createDataFrame([(M[0], M[1]), (P[0], P[1])], "lon double, lat double")
    d = [r.d for r in df.select(geo.distance(F.lit(M[0]), F.lit(M[1]), "lon", "lat").alias("d")).collect()]
    assert d[0] < 1.0 and d[1] > 1.0


def _brute_revise(trades, customers):
    ms = lambda t: int(t.timestamp() * 1000)
    arr = lambda t, i: ms(t) + (i * 7919) % 7000
    out = []
    for tid, cid, tts in trades:
        mine = [c for c in customers if c[0] == cid and c[1] <= tts]
        seen = [c for c in mine if (arr(c[1], c[3]), c[3]) < (arr(tts, tid), tid)]
        r0 = max(seen, key=lambda c: (c[1], c[3]), default=None)
        r1 = max(mine, key=lambda c: (c[1], c[3]), default=None)
        out.append((tid, 0, r0[2] if r0 else None))
        if (r0 and r0[3]) != (r1 and r1[3]):
            out.append((tid, 1, r1[2] if r1 else None))
    return sorted(out, key=lambda r: (r[0], r[1]))


def test_asof_revise_against_brute_force(spark):
    from riverbed.plans.alerts import asof_revise_df
    base = datetime(2024, 1, 1)
    rng = np.random.default_rng(7)
    customers = [(int(rng.integers(0, 3)), base + timedelta(milliseconds=int(rng.integers(0, 60000))), f"c{i}", 1000 + i)
                 for i in range(60)]
    trades = [(i, int(rng.integers(0, 3)), base + timedelta(milliseconds=int(rng.integers(0, 60000)))) for i in range(80)]
    t = spark.createDataFrame(trades, "trade_id long, customer_id long, trade_ts timestamp_ntz")
    c = spark.createDataFrame(customers, "customer_id long, cust_ts timestamp_ntz, customer_info string, event_id long")
    got = sorted(((r.trade_id, r.revision, r.customer_info) for r in asof_revise_df(t, c).collect()),
                 key=lambda r: (r[0], r[1]))
    want = _brute_revise(trades, customers)
    assert any(r[1] == 1 for r in want)
    assert got == want


def test_rolling_sum_literal_case(spark):
    """(1,2,2) (2,3,1) (2,2,4) (1,5,3): key field 0, summed field 1, in arrival order."""
    from riverbed.operators.running import running_sum
    rows = [(0, 1, 2, 2), (1, 2, 3, 1), (2, 2, 2, 4), (3, 1, 5, 3)]
    df = spark.createDataFrame(rows, "seq long, k long, a long, b long")
    got = sorted((r.seq, r.s) for r in running_sum(df, ["k"], ["seq"], F.lit(0), F.col("a"), "s").collect())
    assert got == [(0, 2), (1, 3), (2, 5), (3, 7)]


def _at(minute):
    import datetime
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


def test_threshold_history_and_removal(spark):
    """(sensor_1, 5.0), then 1.2, then 0.5 (removes), default 4.0: a reading meets
    the rule of its own time."""
    from riverbed.plans.alerts import threshold_alerts
    rules = spark.createDataFrame([("s1", 0, 5.0, _at(0)), ("s1", 1, 1.2, _at(20)), ("s1", 2, 0.5, _at(40))],
                                  "id string, rule_id long, threshold double, set_at timestamp_ntz")
    reads = spark.createDataFrame(
        [("s1", 1, _at(10), 45.0, 10.0), ("s1", 2, _at(20), 13.0, 10.0), ("s1", 3, _at(50), 39.0, 10.0),
         ("s1", 4, _at(51), 41.0, 10.0), ("s2", 5, _at(51), 41.0, 10.0), ("s2", 6, _at(52), 39.0, 10.0)],
        "sensor_id string, event_id long, ts timestamp_ntz, temp double, last_temp double")
    assert sorted(r.event_id for r in threshold_alerts(reads, rules).collect()) == [2, 4, 5]


def test_held_rules_drop_arrivals_for_good(spark):
    """A rule arriving while its key is held never comes back; one that begins as
    the held one ends is taken."""
    from riverbed.plans.rules import active_matches
    rules = spark.createDataFrame(
        [(1, 7, 1, 3, _at(0), _at(60)), (2, 7, 1, 3, _at(30), _at(90)), (3, 7, 1, 3, _at(60), _at(70)),
         (4, 7, 1, 9, _at(30), _at(90))],
        "alert_use_id long, client_id long, entity_type_id int, entity_id long, begin_ts timestamp_ntz, end_ts timestamp_ntz")
    clicks = spark.createDataFrame(
        [(10, _at(0), 7, 3, None, None), (11, _at(65), 7, 3, None, None), (12, _at(80), 7, 3, None, None),
         (13, _at(80), 7, 9, None, None)],
        "event_id long, ts timestamp_ntz, client_id long, publisher_id long, offer_id long, campaign_id long")
    assert sorted((r.event_id, r.alert_use_id) for r in active_matches(clicks, rules).collect()) == [
        (10, 1), (11, 3), (13, 4)]


def test_mail_archive_literal(spark):
    """Header names in any case, soft breaks, and records left out for a bad time,
    a missing subject, a delimiter in a field or no body."""
    from riverbed.plans.codecs_io import parse_archive
    def mail(first, *lines):
        return ("-" + first + "\n" + "\n".join(lines) + "\n",)
    when = "1@example.org Tue Mar  5 23:04:09 2013"
    rows = [
        mail(when, "SUBJECT: a", "from: A <a@x>", "Message-id: <1>", "Date: Tue, 5 Mar 2013 16:04:09 -0700", "",
             "long li=", "ne", "end"),
        mail(when, "Subject: old", "Subject: b", "From: B", "Message-ID: <2>", "In-Reply-To: <1>", " ", "x"),
        mail("1@example.org Tue Foo  5 23:04:09 2013", "Subject: c", "From: C", "Message-ID: <3>", "", "x"),
        mail(when, "From: D", "Message-ID: <4>", "", "x"),
        mail(when, "Subject: e#|#e", "From: E", "Message-ID: <5>", "", "x"),
        mail(when, "Subject: f", "From: F", "Message-ID: <6>", ""),
        mail(when, "Subject: g", "From: G", "", "Message-ID: <7>"),
    ]
    got = sorted(tuple(r) for r in parse_archive(spark.createDataFrame(rows, "value string")).collect())
    assert got == [
        ("<1>", "2013-03-05-23:04:09", "A <a@x>", "a", "\nlong line\nend\n", "null"),
        ("<2>", "2013-03-05-23:04:09", "B", "b", " \nx\n", "<1>"),
    ]


def test_cells_on_way_against_predicate(spark):
    """Random segments against a test of every cell of the bounding box; null
    coordinates give null; both directions agree; the UDF counts alike."""
    import random

    from riverbed.functions import geo
    from riverbed.plans.udfs import cells_on_way_count
    rng = random.Random(5)
    pt = lambda: (geo.LON_WEST + (rng.randrange(12) + 0.5) * geo.DELTA_LON,
                  geo.LAT_NORTH - (rng.randrange(12) + 0.5) * geo.DELTA_LAT)
    rows = [(i, *pt(), *pt()) for i in range(300)]
    df = spark.createDataFrame(rows + [(300, None, 40.6, -74.0, 40.6)], "id long, a double, b double, c double, d double")
    got = df.select("id", geo.grid_x("a").alias("x1"), geo.grid_y("b").alias("y1"), geo.grid_x("c").alias("x2"),
                    geo.grid_y("d").alias("y2"), geo.cells_on_way("a", "b", "c", "d").alias("there"),
                    geo.cells_on_way("c", "d", "a", "b").alias("back"),
                    cells_on_way_count("a", "b", "c", "d").alias("n")).collect()
    for r in got:
        if r.id == 300:
            assert r.there is None and r.n is None
            continue
        (x0, y0), (x1, y1) = sorted([(r.x1, r.y1), (r.x2, r.y2)], key=lambda p: p[0]) if r.x1 != r.x2 else \
            [(r.x1, r.y1), (r.x2, r.y2)]
        w, d, up = x1 - x0, abs(y1 - y0), 1 if y1 >= y0 else -1
        s = d / (w + 1e-8)
        want = {x0 + i + (y0 + up * j) * 250 for i in range(w + 1) for j in range(d + 1)
                if (i == 0 or (i - 0.5) * s <= j + 0.45)
                and (i == w or (i + 0.5) * s > j - 0.45 or (i == 0 and j == 0) or (i > 0 and (i - 0.5) * s > j - 0.55))}
        assert set(r.there) == want and len(r.there) == len(want) == r.n
        assert w == 0 or sorted(r.back) == sorted(r.there)

