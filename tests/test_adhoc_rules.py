"""Ad-hoc rules as rows with arrival times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riverbed.operators import adhoc
from riverbed.plans.ride_state import placed_rides

T0 = dt.datetime(2000, 1, 1)
# fixed values: the two places of the reference's query test
PENN, MOMA = (-73.9947, 40.750626), (-73.9776, 40.7614)
RIDES = ("ride_id long, is_start boolean, event_time timestamp_ntz, start_time timestamp_ntz, start_lon double, start_lat double, "
         "end_lon double, end_lat double, taxi_id long, driver_id long, passenger_cnt long")
NEAR = (f"110.25D * sqrt(({MOMA[1]}D - lat) * ({MOMA[1]}D - lat) + (({MOMA[0]}D - lon) * cos(lat)) * (({MOMA[0]}D - lon) * cos(lat))) < 1.0D")


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def ask(spark, rides, rules):
    r = spark.createDataFrame([(i, s, at(m), T0, *a, *b, taxi, 0, 1) for i, s, m, a, b, taxi in rides], RIDES)
    table = spark.createDataFrame([(i, m if m is None else at(m), t) for i, m, t in rules],
                                  "rule_id long, arrives timestamp_ntz, predicate string")
    order = [(~F.col("is_start")).alias("is_end"), F.col("ride_id")]
    out = adhoc.adhoc_rules(placed_rides(r), table, "taxi_id", "event_time", order, 60_000)
    return sorted((x["rule_id"], x["asked"], x["ride_id"], x["is_start"]) for x in out.collect())


def test_ongoing_ride(spark):
    """A rule asks for starts before the ride comes, or after it."""
    ride = [(1, True, 0, (0.0, 0.0), (0.0, 0.0), 1)]
    assert ask(spark, ride, [(1, -1, "is_start")]) == [(1, "row", 1, True)]
    assert ask(spark, ride, [(1, 1, "is_start")]) == [(1, "rule", 1, True)]


def test_taxi_that_ended_nearby(spark):
    rides = [(1, True, 0, PENN, (0.0, 0.0), 1), (1, False, 5, PENN, MOMA, 1)]
    assert ask(spark, rides, [(7, -1, NEAR)]) == [(7, "row", 1, False)]
    assert ask(spark, rides, [(7, 9, NEAR)]) == [(7, "rule", 1, False)]
    assert ask(spark, rides, [(7, 3, NEAR)]) == [(7, "row", 1, False)]


def test_rules_replace_each_other_and_see_the_watermark(spark):
    rides = [(1, True, 0, PENN, MOMA, None), (2, True, 1, PENN, MOMA, None), (3, True, 2, PENN, MOMA, 5), (4, True, 20, PENN, MOMA, 5)]
    rules = [(1, 1.5, "is_start"), (2, 10, "watermark - event_ms >= 480000"), (3, 10, "taxi_id is null"), (4, None, "is_start"), (5, 4, None)]
    assert ask(spark, rides, rules) == [(1, "row", 3, True), (1, "rule", 2, True), (2, "rule", 2, True), (3, "rule", 2, True)]


def test_no_rules_and_too_many(spark, monkeypatch):
    ride = [(1, True, 0, PENN, MOMA, 1)]
    assert ask(spark, ride, []) == [] and ask(spark, [], [(1, 0, "is_start")]) == []
    monkeypatch.setattr(adhoc, "MAX_RULES", 1)
    with pytest.raises(ValueError):
        ask(spark, ride, [(1, 0, "is_start"), (2, 1, "is_start")])


def test_the_number_of_rules_is_found_once_a_row(spark):
    """Forty rules: the search among their arrivals isn't copied into the branch of each."""
    rides = spark.createDataFrame([(i, True, at(i), T0, *PENN, *MOMA, i % 2, 0, 1) for i in range(50)], RIDES)
    rules = spark.createDataFrame([(i, at(i), f"ride_id % 40 = {i}") for i in range(40)], "rule_id long, arrives timestamp_ntz, predicate string")
    out = adhoc.adhoc_rules(placed_rides(rides), rules, "taxi_id", "event_time", [F.col("ride_id")], 0)
    asked = sorted((x["rule_id"], x["asked"], x["ride_id"]) for x in out.collect())
    assert asked == [(i, "row", i) for i in range(40)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # once for rows that come, once for the newest rows
    assert plan.count("lambdafunction") <= 4 and "array_position" not in plan
