"""Ride queries over the city grid: cleansing, grid functions, popular places, nearest taxi."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions import geo
from riverbed.functions.time import epoch_micros, from_epoch_micros
from riverbed.operators.joins import asof_join
from riverbed.operators.nearest import nearest_so_far, nearest_with_reset
from riverbed.operators.running import CHUNK_ROWS
from riverbed.operators.windows import sliding_agg
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views

RV = with_views("rides")

# DuckDB spellings of the grid expressions (oracle side)
D_IN_NYC = "({lon} BETWEEN -74.05e0 AND -73.7e0 AND {lat} BETWEEN 40.5e0 AND 41.0e0)"
D_GX = "CAST(floor((74.05e0 - abs({lon})) / 0.0014e0) AS BIGINT)"
D_GY = "CAST(floor((41.0e0 - {lat}) / 0.00125e0) AS BIGINT)"
D_CELL = "(CAST(floor((74.05e0 - abs({lon})) / 0.0014e0) AS INTEGER) + CAST(floor((41.0e0 - {lat}) / 0.00125e0) AS INTEGER) * 250)"
D_CLON = "CAST((74.05e0 - ({c} % 250) * 0.0014e0 - 0.0014e0 / 2) * -1.0e0 AS FLOAT)"
D_CLAT = "CAST(41.0e0 - floor(({c} - {c} % 250) / 250) * 0.00125e0 - 0.00125e0 / 2 AS FLOAT)"
D_DIST = "(110.25e0 * sqrt(({lat1} - {lat2}) * ({lat1} - {lat2}) + (({lon1} - {lon2}) * cos({lat2})) * (({lon1} - {lon2}) * cos({lat2}))))"


def cleansed(rides: DataFrame) -> DataFrame:
    """Rides whose start and end both lie inside the city box (PF6)."""
    return rides.filter(geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))


@query("ride_cleansing", RV + "SELECT * FROM rides WHERE " + D_IN_NYC.format(lon="start_lon", lat="start_lat")
       + " AND " + D_IN_NYC.format(lon="end_lon", lat="end_lat"))
def ride_cleansing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleansed(views.rides(spark, sf_dir))


@query("geo_in_box", RV + "SELECT ride_id, is_start, " + D_IN_NYC.format(lon="start_lon", lat="start_lat")
       + " AS start_in_nyc, " + D_IN_NYC.format(lon="end_lon", lat="end_lat") + " AS end_in_nyc FROM rides")
def geo_in_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = views.rides(spark, sf_dir)
    return r.select("ride_id", "is_start", geo.in_nyc("start_lon", "start_lat").alias("start_in_nyc"),
                    geo.in_nyc("end_lon", "end_lat").alias("end_in_nyc"))


@query("geo_grid_cell", RV + "SELECT ride_id, is_start, " + D_CELL.format(lon="start_lon", lat="start_lat")
       + " AS start_cell, " + D_CELL.format(lon="end_lon", lat="end_lat") + " AS end_cell FROM rides")
def geo_grid_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = views.rides(spark, sf_dir)
    return r.select("ride_id", "is_start", geo.grid_cell("start_lon", "start_lat").alias("start_cell"),
                    geo.grid_cell("end_lon", "end_lat").alias("end_cell"))


@query("geo_cell_center", RV + f"""
, cells AS (SELECT DISTINCT {D_CELL.format(lon="start_lon", lat="start_lat")} AS cell FROM rides)
SELECT cell, {D_CLON.format(c="cell")} AS center_lon, {D_CLAT.format(c="cell")} AS center_lat FROM cells""")
def geo_cell_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centre of every start cell in use."""
    cells = views.rides(spark, sf_dir).select(geo.grid_cell("start_lon", "start_lat").alias("cell")).distinct()
    return cells.select("cell", geo.cell_center_lon("cell").alias("center_lon"), geo.cell_center_lat("cell").alias("center_lat"))


@query("geo_distance", RV + "SELECT ride_id, is_start, round("
       + D_DIST.format(lon1="start_lon", lat1="start_lat", lon2="end_lon", lat2="end_lat") + ", 6) AS distance FROM rides")
def geo_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = views.rides(spark, sf_dir)
    return r.select("ride_id", "is_start",
                    F.round(geo.distance("start_lon", "start_lat", "end_lon", "end_lat"), 6).alias("distance"))


@query("geo_direction", RV + """
SELECT ride_id, is_start,
  CAST(trunc(degrees(atan2(end_lat - start_lat, (end_lon - start_lon) * cos(start_lat)))) AS INTEGER) + 179 AS direction
FROM rides""")
def geo_direction(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = views.rides(spark, sf_dir)
    return r.select("ride_id", "is_start", geo.direction("start_lon", "start_lat", "end_lon", "end_lat").alias("direction"))


# A cell (i columns, j rows from the western end) is on the line when the line
# neither passes above it before its left edge nor below it after its right edge,
# with 0.05 of a cell left to the corners: tested for every cell of the bounding
# box of every distinct segment.
ON_WAY_SQL = RV + f"""
, ride AS (
  SELECT ride_id, {D_GX.format(lon="start_lon")} AS x1, {D_GY.format(lat="start_lat")} AS y1,
         {D_GX.format(lon="end_lon")} AS x2, {D_GY.format(lat="end_lat")} AS y2 FROM rides WHERE is_start),
seg AS (
  SELECT x1, y1, x2, y2, list(ride_id) AS ride_ids, least(x1, x2) AS x0, CASE WHEN x1 <= x2 THEN y1 ELSE y2 END AS y0,
         abs(x2 - x1) AS w, abs(y2 - y1) AS d, CASE WHEN (x1 <= x2) = (y1 <= y2) THEN 1 ELSE -1 END AS up,
         abs(y2 - y1) / (abs(x2 - x1) + 0.00000001e0) AS s
  FROM ride GROUP BY ALL),
box AS (SELECT seg.*, i, j FROM seg, LATERAL (SELECT unnest(range(0, w + 1)) AS i),
               LATERAL (SELECT unnest(range(0, d + 1)) AS j)),
on_way AS (
  SELECT ride_ids, x0 + i + (y0 + up * j) * 250 AS cell FROM box
  WHERE (i = 0 OR (i - 0.5e0) * s <= j + 0.45e0)
    AND (i = w OR (i + 0.5e0) * s > j - 0.45e0 OR (i = 0 AND j = 0) OR (i > 0 AND (i - 0.5e0) * s > j - 0.55e0)))
"""


@query("geo_cells_on_way", ON_WAY_SQL + """
SELECT cell, CAST(sum(len(ride_ids)) AS BIGINT) AS n_rides FROM on_way GROUP BY cell""")
def geo_cells_on_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides passing through each grid cell, from the cells on each ride's straight path.

    The path depends on the two end cells only: rides are counted per pair of end
    cells first (a partial aggregate), and a path is built once per pair."""
    r = views.rides(spark, sf_dir).filter("is_start")
    ends = ["start_lon", "start_lat", "end_lon", "end_lat"]
    pairs = r.groupBy(geo.grid_cell("start_lon", "start_lat").alias("c1"), geo.grid_cell("end_lon", "end_lat").alias("c2")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*ends)).alias("p"))
    cells = pairs.select("n", F.explode(geo.cells_on_way(*[F.col(f"p.{c}") for c in ends])).alias("cell"))
    return cells.groupBy("cell").agg(F.sum("n").alias("n_rides"))


POPULAR_THRESHOLD = 2


def popular_places_df(rides: DataFrame, threshold: int = POPULAR_THRESHOLD) -> DataFrame:
    """Cells with at least ``threshold`` START (or END) events in a 15 min window
    sliding by 5 min; START events count at the start cell, END events at the
    end cell (ST6)."""
    pts = cleansed(rides).select(
        F.when(F.col("is_start"), geo.grid_cell("start_lon", "start_lat"))
         .otherwise(geo.grid_cell("end_lon", "end_lat")).alias("cell"), "is_start", "event_time")
    c = sliding_agg(pts, "event_time", "15 minutes", "5 minutes", ["cell", "is_start"], {"cnt": F.count(F.lit(1))})
    return c.filter(F.col("cnt") >= threshold).select(
        geo.cell_center_lon("cell").alias("lon"), geo.cell_center_lat("cell").alias("lat"),
        "window_end", "is_start", "cnt")


POPULAR_SQL = RV + f"""
, pts AS (
  SELECT CASE WHEN is_start THEN {D_CELL.format(lon="start_lon", lat="start_lat")}
              ELSE {D_CELL.format(lon="end_lon", lat="end_lat")} END AS cell, is_start, event_time FROM rides
  WHERE {D_IN_NYC.format(lon="start_lon", lat="start_lat")} AND {D_IN_NYC.format(lon="end_lon", lat="end_lat")}),
win AS (
  SELECT cell, is_start, time_bucket(INTERVAL '5 minutes', event_time) - k * INTERVAL '5 minutes' + INTERVAL '15 minutes'
         AS window_end FROM pts, range(0, 3) r(k)),
popular AS (
  SELECT {D_CLON.format(c="cell")} AS lon, {D_CLAT.format(c="cell")} AS lat, window_end, is_start, count(*) AS cnt
  FROM win GROUP BY cell, is_start, window_end HAVING count(*) >= {POPULAR_THRESHOLD})
"""


@query("popular_places", POPULAR_SQL + "SELECT * FROM popular")
def popular_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popular_places_df(views.rides(spark, sf_dir))


@query("popular_places_json_docs", POPULAR_SQL + """
SELECT '{"time":"' || CAST(epoch_ms(window_end) AS VARCHAR) || '","location":"' || CAST(lat AS VARCHAR) || ','
       || CAST(lon AS VARCHAR) || '","isStart":"' || CAST(is_start AS VARCHAR) || '","cnt":"' || CAST(cnt AS VARCHAR)
       || '"}' AS doc FROM popular""")
def popular_places_json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-index documents: every value a string, location as "lat,lon" (IO11)."""
    return popular_places_df(views.rides(spark, sf_dir)).select(place_document().alias("doc"))


def place_document() -> Column:
    from riverbed.functions.time import epoch_millis
    return F.to_json(F.struct(
        epoch_millis("window_end").cast("string").alias("time"),
        F.concat_ws(",", F.col("lat").cast("string"), F.col("lon").cast("string")).alias("location"),
        F.col("is_start").cast("string").alias("isStart"), F.col("cnt").cast("string").alias("cnt")))


def taxi_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-taxi requests: every signup event asks from a lattice point at its time."""
    from riverbed.sources.tables import table
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return ev.filter(F.col("event_type") == "signup").select(
        eid.alias("query_id"), F.col("ts").alias("q_time"),
        (F.lit(-74.04) + F.lit(0.02) * ((eid * 13) % 20)).alias("q_lon"),
        (F.lit(40.51) + F.lit(0.04) * ((eid * 17) % 14)).alias("q_lat"))


TAXI_SQL = RV + f"""
, q AS (SELECT event_id AS query_id, ts AS q_time, -74.04e0 + 0.02e0 * ((event_id * 13) % 20) AS q_lon,
               40.51e0 + 0.04e0 * ((event_id * 17) % 14) AS q_lat FROM events WHERE event_type = 'signup'),
pairs AS (
  SELECT query_id, ride_id, taxi_id, event_time,
         {D_DIST.format(lon1="q_lon", lat1="q_lat", lon2="end_lon", lat2="end_lat")} AS distance
  FROM q JOIN rides ON NOT is_start AND event_time BETWEEN q_time AND q_time + INTERVAL '15 minutes')
"""
LIFE_US = 15 * 60 * 1_000_000
RETENTION_US = 8 * 3600 * 1_000_000


def taxi_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of rides as points in time and place."""
    return views.rides(spark, sf_dir).filter(~F.col("is_start")).select(
        "ride_id", "taxi_id", epoch_micros("event_time").alias("us"), F.col("end_lon").alias("lon"), F.col("end_lat").alias("lat"))


def nearest_taxis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nearer taxi of a request's 15 minutes, through numbers and cells instead of pairs."""
    q = taxi_queries(spark, sf_dir).withColumn("from_us", epoch_micros("q_time"))
    q = q.select("query_id", F.col("q_lon").alias("lon"), F.col("q_lat").alias("lat"), "from_us", (F.col("from_us") + LIFE_US).alias("upto_us"))
    return nearest_so_far(q, taxi_ends(spark, sf_dir), "query_id", "ride_id")


@query("nearest_taxi", TAXI_SQL + """
SELECT query_id, ride_id, taxi_id, round(distance, 6) AS distance FROM (
  SELECT *, min(distance) OVER (PARTITION BY query_id ORDER BY event_time, ride_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_min FROM pairs)
WHERE prev_min IS NULL OR distance < prev_min""")
def nearest_taxi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request, each ending ride that is closer than every earlier one (J12 + W4)."""
    return nearest_taxis(spark, sf_dir).select("query_id", "ride_id", "taxi_id", F.round("distance", 6).alias("distance"))


@query("nearest_taxi_expiring", TAXI_SQL + """
SELECT query_id, arg_min(ride_id, (distance, event_time, ride_id)) AS ride_id,
       arg_min(taxi_id, (distance, event_time, ride_id)) AS taxi_id, round(min(distance), 6) AS distance
FROM pairs GROUP BY query_id""")
def nearest_taxi_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per request, the closest taxi ending within the request's 15 min lifetime (J13, ST21)."""
    best = F.max_by(F.struct("ride_id", "taxi_id", "distance"), F.struct("us", "ride_id"))
    return nearest_taxis(spark, sf_dir).groupBy("query_id").agg(best.alias("b")).select(
        "query_id", F.col("b.ride_id").alias("ride_id"), F.col("b.taxi_id").alias("taxi_id"),
        F.round("b.distance", 6).alias("distance"))


# the steps of a request's rides in order: (best, when) goes after 8 h without a nearer one
CLEANUP_SQL = RV + f"""
, q AS (SELECT event_id AS query_id, ts AS q_time, CASE WHEN event_id % 3 = 0 THEN 0e0 ELSE -74.04e0 + 0.02e0 * ((event_id * 13) % 20) END AS q_lon,
               40.51e0 + 0.04e0 * ((event_id * 17) % 14) AS q_lat FROM events WHERE event_type = 'signup'),
life AS (SELECT *, (SELECT min(n.q_time) FROM q n WHERE n.q_time > q.q_time + INTERVAL '15 minutes') AS gone FROM q WHERE q_lon <> 0),
pairs AS (
  SELECT query_id, ride_id, taxi_id, event_time,
         {D_DIST.format(lon1="q_lon", lat1="q_lat", lon2="end_lon", lat2="end_lat")} AS distance,
         row_number() OVER (PARTITION BY query_id ORDER BY event_time, ride_id) AS n
  FROM life JOIN rides ON NOT is_start AND event_time >= q_time AND (gone IS NULL OR event_time < gone)),
step AS (
  SELECT query_id, ride_id, taxi_id, event_time, distance, n, distance AS best, event_time AS since, TRUE AS nearer FROM pairs WHERE n = 1
  UNION ALL
  SELECT p.query_id, p.ride_id, p.taxi_id, p.event_time, p.distance, p.n,
         CASE WHEN p.distance < s.best OR p.event_time > s.since + INTERVAL '8 hours' THEN p.distance ELSE s.best END,
         CASE WHEN p.distance < s.best OR p.event_time > s.since + INTERVAL '8 hours' THEN p.event_time ELSE s.since END,
         p.distance < s.best OR p.event_time > s.since + INTERVAL '8 hours'
  FROM step s JOIN pairs p ON p.query_id = s.query_id AND p.n = s.n + 1)
SELECT query_id, ride_id, taxi_id, event_time, round(distance, 6) AS distance FROM step WHERE nearer
"""


@query("nearest_taxi_cleanup", CLEANUP_SQL.replace("WITH ", "WITH RECURSIVE ", 1))
def nearest_taxi_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lazy form (J13, ST21): a request stays open until the first request that comes
    over 15 minutes later; one of longitude 0 only cleans up.  A request that saw no
    nearer taxi for 8 hours forgets its best."""
    q = taxi_queries(spark, sf_dir).withColumn("q_lon", F.when(F.col("query_id") % 3 == 0, 0.0).otherwise(F.col("q_lon")))
    q = q.select("query_id", F.col("q_lon").alias("lon"), F.col("q_lat").alias("lat"), epoch_micros("q_time").alias("from_us"))
    ends = taxi_ends(spark, sf_dir)
    return nearest_with_reset(open_until_cleanup(q, ends, LIFE_US), ends, "query_id", "ride_id", RETENTION_US).select(
        "query_id", "ride_id", "taxi_id", from_epoch_micros("us").alias("event_time"), F.round("distance", 6).alias("distance"))


def open_until_cleanup(requests: DataFrame, points: DataFrame, life_us: int) -> DataFrame:
    """Requests with a place, open until the first request over ``life_us`` later (its instant
    no longer belongs to them); without one, to the end of ``points``."""
    # the next one in time is the newest one in reversed time
    asked = requests.filter(F.col("lon") != 0).withColumn("back", -(F.col("from_us") + (life_us + 1)))
    gone = requests.select((-F.col("from_us")).alias("gone_back"), F.col("from_us").alias("gone_us"))
    low, high, n = gone.agg(F.min("gone_back"), F.max("gone_back"), F.count("*")).first()
    width = max(1, ((high or 0) - (low or 0)) * CHUNK_ROWS // max(n, 1))
    last = points.agg(F.max("us")).first()[0]
    open_ = asof_join(asked, gone, [], "back", "gone_back", ["gone_us"], chunk_fn=lambda t: F.floor(t / width))
    return open_.select("query_id", "lon", "lat", "from_us", F.coalesce(F.col("gone_us") - 1, F.lit(last)).alias("upto_us"))
