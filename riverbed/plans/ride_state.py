"""Keyed-state ride queries, in batch form: rides ⋈ fares, expiring state, long
rides, latest ride per taxi, ongoing rides, running counts, trip events, ad-hoc
predicates.  Streaming twins live in ``riverbed.streaming``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riverbed.functions import geo
from riverbed.functions.time import epoch_micros, epoch_millis, minutes_between
from riverbed.operators.adhoc import adhoc_rules
from riverbed.operators.running import running_sum, volume_chunk
from riverbed.plans.geo_places import D_DIST, D_IN_NYC, cleansed
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.session import materialize
from riverbed.sources import views
from riverbed.sources.tables import table

RF = with_views("rides", "fares")
TWO_HOURS_MS = 2 * 60 * 60 * 1000


def starts(rides: DataFrame) -> DataFrame:
    return rides.filter(F.col("is_start"))


def enriched(rides: DataFrame, fares: DataFrame) -> DataFrame:
    """One-to-one START ride ⋈ fare on ride id (J4). Both sides shuffle on ride_id;
    AQE picks broadcast only when a side's measured size allows it."""
    r = starts(rides).select("ride_id", "taxi_id", "driver_id", "start_time", "passenger_cnt")
    f = fares.select("ride_id", "payment_type", "tip", "total_fare")
    return r.join(f, "ride_id", "inner")


@query("enrich_rides_fares", RF + """
SELECT r.ride_id, r.taxi_id, r.driver_id, r.start_time, r.passenger_cnt, f.payment_type, f.tip, f.total_fare
FROM rides r JOIN fares f ON r.ride_id = f.ride_id WHERE r.is_start""")
def enrich_rides_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(views.rides(spark, sf_dir), views.fares(spark, sf_dir))


def _kept_starts(rides: DataFrame) -> DataFrame:
    # the expiring-state program drops START rides whose id is a multiple of 1000 (simulated loss)
    return starts(rides).filter(F.col("ride_id") % 1000 != 0)


@query("unmatched_fares", RF + """
SELECT * FROM fares f WHERE NOT EXISTS (
  SELECT 1 FROM rides r WHERE r.is_start AND r.ride_id % 1000 <> 0 AND r.ride_id = f.ride_id)""")
def unmatched_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares whose ride never arrives (J5 side output)."""
    r = _kept_starts(views.rides(spark, sf_dir)).select("ride_id")
    return views.fares(spark, sf_dir).join(r, "ride_id", "left_anti")


@query("unmatched_rides", RF + """
SELECT * FROM rides r WHERE r.is_start AND r.ride_id % 1000 <> 0 AND NOT EXISTS (
  SELECT 1 FROM fares f WHERE r.ride_id = f.ride_id)""")
def unmatched_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """START rides whose fare never arrives (J5 side output)."""
    f = views.fares(spark, sf_dir).select("ride_id")
    return _kept_starts(views.rides(spark, sf_dir)).join(f, "ride_id", "left_anti")


def long_rides_df(rides: DataFrame, strict: bool = False) -> DataFrame:
    """START rides with no END of the same ride within two hours of the start
    (ST18); an END may arrive before its START.  ``strict`` uses ``<`` (the
    pattern form, ST17) instead of ``<=`` (the timer form)."""
    s = starts(rides)
    e = rides.filter(~F.col("is_start")).select("ride_id", F.col("event_time").alias("end_event_time"))
    within = F.timestamp_diff("MILLISECOND", s["start_time"], F.col("end_event_time"))
    ok = (within < TWO_HOURS_MS) if strict else (within <= TWO_HOURS_MS)
    return s.join(e, (s["ride_id"] == e["ride_id"]) & ok, "left_anti")


LONG_SQL = """
SELECT * FROM rides s WHERE s.is_start AND NOT EXISTS (
  SELECT 1 FROM rides e WHERE NOT e.is_start AND e.ride_id = s.ride_id
  AND e.event_time {op} s.start_time + INTERVAL '2 hours')"""


@query("long_rides", with_views("rides") + LONG_SQL.format(op="<="))
def long_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long_rides_df(views.rides(spark, sf_dir))


@query("long_rides_cleansed", with_views("rides", extra={"clean": "SELECT * FROM rides WHERE "
       + D_IN_NYC.format(lon="start_lon", lat="start_lat") + " AND " + D_IN_NYC.format(lon="end_lon", lat="end_lat")})
       + LONG_SQL.format(op="<=").replace("FROM rides", "FROM clean"))
def long_rides_cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long rides among rides inside the city box (checkpointed variant of ST18)."""
    return long_rides_df(cleansed(views.rides(spark, sf_dir)))


@query("cep_long_rides", with_views("rides") + LONG_SQL.format(op="<"))
def cep_long_rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern START → END within 120 min; output the timed-out partial matches (ST17)."""
    return long_rides_df(views.rides(spark, sf_dir), strict=True)


def latest_per_taxi(rides: DataFrame) -> DataFrame:
    """Newest ride event per taxi by (event time, START before END, ride id).
    A partial ``max_by`` aggregate: a hot taxi is pre-reduced map-side."""
    order = F.struct("event_time", (~F.col("is_start")).alias("is_end"), "ride_id")
    best = F.max_by(F.struct("ride_id", "is_start", "event_time", "start_time"), order)
    return rides.groupBy("taxi_id").agg(best.alias("b")).select("taxi_id", "b.*")


LATEST_SQL = """
, latest AS (SELECT taxi_id, ride_id, is_start, event_time, start_time FROM (
  SELECT *, row_number() OVER (PARTITION BY taxi_id ORDER BY event_time DESC, NOT is_start DESC, ride_id DESC) AS rn
  FROM rides) WHERE rn = 1)"""


@query("latest_ride_per_taxi", with_views("rides") + LATEST_SQL + " SELECT * FROM latest")
def latest_ride_per_taxi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_taxi(views.rides(spark, sf_dir))


ONGOING_MINUTES = 60


@query("ongoing_rides", with_views("rides") + LATEST_SQL + f"""
SELECT taxi_id, ride_id, start_time,
       round(epoch_ms((SELECT max(event_time) FROM rides) - start_time) / 60000e0, 6) AS minutes_ongoing
FROM latest WHERE is_start
  AND epoch_ms((SELECT max(event_time) FROM rides) - start_time) / 60000e0 >= {ONGOING_MINUTES}""")
def ongoing_rides(spark: SparkSession, sf_dir: str, minutes: int = ONGOING_MINUTES) -> DataFrame:
    """Taxis whose newest event is a START at least ``minutes`` old at the
    watermark, here the newest event time of the input (ST23)."""
    r = views.rides(spark, sf_dir)
    now = r.select(F.max("event_time")).scalar()
    latest = latest_per_taxi(r).filter("is_start")
    mins = minutes_between(F.col("start_time"), now)
    return latest.filter(mins >= minutes).select("taxi_id", "ride_id", "start_time",
                                                 F.round(mins, 6).alias("minutes_ongoing"))


@query("rolling_count", with_views("rides") + """
SELECT ride_id, driver_id,
  CAST(count(*) OVER (PARTITION BY driver_id ORDER BY event_time, ride_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ride_count
FROM rides WHERE is_start""")
def rolling_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running number of rides started per driver, one output per START (A1)."""
    s = starts(views.rides(spark, sf_dir)).select("ride_id", "driver_id", "event_time")
    r = running_sum(s, ["driver_id"], ["event_time", "ride_id"], volume_chunk(s, epoch_micros("event_time")),
                    F.lit(1).cast("bigint"), "ride_count")
    return r.select("ride_id", "driver_id", "ride_count")


TRIPS_SQL = """
WITH trips AS (
  SELECT CAST(row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_shipdate, l_extendedprice, l_discount, l_tax,
                                          l_linestatus) AS BIGINT) AS seq, l_orderkey, l_linenumber,
         l_extendedprice, l_discount, l_tax, l_linestatus, o_orderdate, l_shipdate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
"""


def numbered_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips (order lines: ordered → shipped) with their line number in the input,
    which is ordered by order and line, and by the trip itself where those repeat.

    The input is cut into ranges sized by Spark's range partitioner and written
    once; a range's rows carry their place in it, and a table of one row per
    range gives the offsets, so no task numbers more than its own range.
    """
    order = ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
    li = table(spark, sf_dir, "lineitem").select(*order)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    trips = li.join(o, li.l_orderkey == o.o_orderkey).drop("o_orderkey")
    placed = materialize(
        trips.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id()), "trips")
    # the id holds the partition above 33 bits of row position
    placed = placed.withColumn("_range", F.shiftright("_place", 33)) \
        .withColumn("_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(offsets, "_range").withColumn("seq", F.col("_before") + F.col("_place") + 1).drop(
        "_range", "_place", "_before")


@query("trips_to_events", TRIPS_SQL + """
SELECT seq, l_orderkey, l_linenumber, 'START' AS event_type, o_orderdate AS event_time,
       TIMESTAMP '1970-01-01 00:00:00' AS other_time FROM trips
UNION ALL
SELECT seq, l_orderkey, l_linenumber, 'END', l_shipdate, o_orderdate FROM trips""")
def trips_to_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trip becomes a START event (its end time still the epoch) and an END
    event (with its start time), both with the number of the trip's input line,
    sorted by time (IO8, SO2)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    time = lambda c: F.col(c).cast("timestamp_ntz")
    kinds = F.array(
        F.struct(F.lit("START").alias("event_type"), time("o_orderdate").alias("event_time"), epoch.alias("other_time")),
        F.struct(F.lit("END").alias("event_type"), time("l_shipdate").alias("event_time"),
                 time("o_orderdate").alias("other_time")))
    ev = numbered_trips(spark, sf_dir).select("seq", "l_orderkey", "l_linenumber", F.explode(kinds).alias("e"))
    return ev.select("seq", "l_orderkey", "l_linenumber", "e.*").orderBy("event_time", "other_time", "seq")


@query("trips_to_fares", TRIPS_SQL + """
SELECT seq, l_orderkey, l_linenumber, o_orderdate AS start_time, l_linestatus AS payment_type, l_tax AS tip,
       l_discount AS tolls, l_extendedprice AS total_fare FROM trips""")
def trips_to_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fare form of the same input lines, numbered alike and left in input order (IO8)."""
    return numbered_trips(spark, sf_dir).select(
        "seq", "l_orderkey", "l_linenumber", F.col("o_orderdate").alias("start_time"),
        F.col("l_linestatus").alias("payment_type"), F.col("l_tax").alias("tip"), F.col("l_discount").alias("tolls"),
        F.col("l_extendedprice").alias("total_fare"))


# fixed values: the ad-hoc predicates of the reference's query test, as SQL text over a
# ride event's location (lon, lat); (-73.9776, 40.7614) is the test's second location
ADHOC_RULES = {
    1: "is_start",
    2: "110.25D * sqrt((40.7614D - lat) * (40.7614D - lat) "
       "+ ((-73.9776D - lon) * cos(lat)) * ((-73.9776D - lon) * cos(lat))) < 1.0D",
}


@query("adhoc_predicates", with_views("rides") + f"""
SELECT 1 AS rule_id, ride_id, is_start, event_time FROM rides WHERE is_start
UNION ALL
SELECT 2, ride_id, is_start, event_time FROM rides
WHERE {D_DIST.format(lon1="-73.9776e0", lat1="40.7614e0",
                     lon2="CASE WHEN is_start THEN start_lon ELSE end_lon END",
                     lat2="CASE WHEN is_start THEN start_lat ELSE end_lat END")} < 1.0e0""")
def adhoc_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates arriving as text, each evaluated on every ride (PF12).

    Each rule is compiled by Spark's own expression parser; one scan evaluates
    them all and a ride comes out once per rule that holds.
    """
    r = views.rides(spark, sf_dir).select(
        "ride_id", "is_start", "event_time",
        F.when(F.col("is_start"), F.col("start_lon")).otherwise(F.col("end_lon")).alias("lon"),
        F.when(F.col("is_start"), F.col("start_lat")).otherwise(F.col("end_lat")).alias("lat"))
    met = F.array(*[F.when(F.expr(text), F.lit(rid)) for rid, text in sorted(ADHOC_RULES.items())])
    return r.select(F.explode(F.array_compact(met)).alias("rule_id"), "ride_id", "is_start", "event_time")


# fixed values: the shapes of the rule table's predicates; {x} and {y} place the second one's centre
RULE_TEXTS = ["is_start",
              "110.25D * sqrt((40.51D + 0.04D * {y} - lat) * (40.51D + 0.04D * {y} - lat) + ((-74.04D + 0.02D * {x} - lon) * cos(lat))"
              " * ((-74.04D + 0.02D * {x} - lon) * cos(lat))) < 5.0D",
              "is_start AND watermark - start_ms > 7200000"]
RULE_DELAY_MS = 60_000


def rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rule_id, arrives, predicate``: the first error event of each day brings a rule,
    of the kind event id modulo 3."""
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    day = ev.groupBy(F.to_date("ts").alias("day")).agg(F.min(F.struct("ts", "event_id")).alias("first"))
    eid = F.col("first.event_id")
    place = F.replace(F.replace(F.lit(RULE_TEXTS[1]), F.lit("{x}"), ((eid * 7) % 20).cast("string")),
                      F.lit("{y}"), ((eid * 11) % 14).cast("string"))
    text = F.when(eid % 3 == 0, F.lit(RULE_TEXTS[0])).when(eid % 3 == 1, place).otherwise(F.lit(RULE_TEXTS[2]))
    return day.select(eid.alias("rule_id"), F.col("first.ts").alias("arrives"), text.alias("predicate"))


def placed_rides(rides: DataFrame) -> DataFrame:
    """Ride events as ad-hoc rules see them: the event's own place, and epoch milliseconds."""
    at = lambda c: F.when(F.col("is_start"), F.col(f"start_{c}")).otherwise(F.col(f"end_{c}")).alias(c)
    return rides.select("ride_id", "taxi_id", "driver_id", "passenger_cnt", "is_start", "event_time", at("lon"), at("lat"),
                        epoch_millis("start_time").alias("start_ms"), epoch_millis("event_time").alias("event_ms"))


@query("adhoc_rule_table", with_views("rides") + f"""
, first_error AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
                 FROM events WHERE event_type = 'error') WHERE rn = 1),
rules AS (SELECT event_id AS rule_id, ts AS arrives, event_id % 3 AS kind, -74.04e0 + 0.02e0 * ((event_id * 7) % 20) AS x,
  40.51e0 + 0.04e0 * ((event_id * 11) % 14) AS y, lead(ts) OVER (ORDER BY ts, event_id) AS until FROM first_error),
ev AS (SELECT ride_id, taxi_id, is_start, event_time, epoch_us(start_time) // 1000 AS start_ms,
  CASE WHEN is_start THEN start_lon ELSE end_lon END AS lon, CASE WHEN is_start THEN start_lat ELSE end_lat END AS lat FROM rides),
asked AS (
  SELECT rule_id, kind, x, y, ev.*, 'row' AS asked, epoch_us(event_time) // 1000 - {RULE_DELAY_MS} AS watermark
  FROM ev JOIN rules ON event_time >= arrives AND (until IS NULL OR event_time < until)
  UNION ALL
  SELECT * EXCLUDE (rn) FROM (
    SELECT rule_id, kind, x, y, ev.*, 'rule' AS asked, epoch_us(arrives) // 1000 - {RULE_DELAY_MS} AS watermark,
      row_number() OVER (PARTITION BY rule_id, taxi_id ORDER BY event_time DESC, NOT is_start DESC, ride_id DESC) AS rn
    FROM ev JOIN rules ON event_time < arrives) WHERE rn = 1)
SELECT rule_id, asked, ride_id, is_start, event_time, watermark FROM asked
WHERE CASE kind WHEN 0 THEN is_start
  WHEN 1 THEN 110.25e0 * sqrt((y - lat) * (y - lat) + ((x - lon) * cos(lat)) * ((x - lon) * cos(lat))) < 5e0
  ELSE is_start AND watermark - start_ms > 7200000 END""")
def adhoc_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PF12 with rules as rows: each holds from its arrival to the next one's, is asked of
    every ride event then, and on arrival of every taxi's newest event."""
    order = [(~F.col("is_start")).alias("is_end"), F.col("ride_id")]
    out = adhoc_rules(placed_rides(views.rides(spark, sf_dir)), rule_table(spark, sf_dir), "taxi_id", "event_time", order, RULE_DELAY_MS)
    return out.select("rule_id", "asked", "ride_id", "is_start", "event_time", "watermark")
