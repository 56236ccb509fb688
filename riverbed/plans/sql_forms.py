"""SQL-text forms of the table programs: the same operators written as Spark SQL
over temp views, with the grid functions registered as SQL functions (F7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riverbed.functions.geo import register_sql_functions
from riverbed.operators.running import range_count
from riverbed.plans.geo_places import D_CELL, D_CLAT, D_CLON, D_IN_NYC, POPULAR_THRESHOLD
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views


def _prepare(spark: SparkSession, sf_dir: str, *names: str, dense: bool = False) -> None:
    for n in names:
        getattr(views, n)(spark, sf_dir, dense).createOrReplaceTempView(n)
    register_sql_functions(spark)


@query("sql_hourly_tips_having", with_views("fares", dense=True) + """
SELECT time_bucket(INTERVAL '1 hour', start_time) + INTERVAL '1 hour' AS window_end, driver_id,
       round(sum(tip), 6) AS total_tips
FROM fares GROUP BY ALL HAVING sum(tip) > 50e0""")
def sql_hourly_tips_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling hour per driver with a post-aggregate filter SUM(tip) > 50 (ST5, PF10)."""
    _prepare(spark, sf_dir, "fares", dense=True)
    return spark.sql("""
        SELECT window(start_time, '1 hour').end AS window_end, driver_id, round(sum(tip), 6) AS total_tips
        FROM fares GROUP BY window(start_time, '1 hour'), driver_id HAVING sum(tip) > 50""")


@query("sql_over_range_count", with_views("rides") + f"""
SELECT ride_id, cell, event_time,
  count(*) OVER (PARTITION BY cell ORDER BY event_time RANGE BETWEEN INTERVAL '10 minutes' PRECEDING AND CURRENT ROW) AS cnt
FROM (SELECT ride_id, {D_CELL.format(lon="start_lon", lat="start_lat")} AS cell, event_time FROM rides
      WHERE is_start AND {D_IN_NYC.format(lon="start_lon", lat="start_lat")})""")
def sql_over_range_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNT(*) OVER a 10-minute RANGE frame per start cell, after a sub-query
    filter (W1).  The engine's own window puts a cell into one task, and there are few
    cells; the count is taken from prefix counts by volume instead."""
    _prepare(spark, sf_dir, "rides")
    starts = spark.sql("""
        SELECT ride_id, to_cell_id(start_lon, start_lat) AS cell, event_time FROM rides
        WHERE is_start AND is_in_nyc(start_lon, start_lat)""")
    return range_count(starts, ["cell"], "event_time", 600_000_000, "cnt").select("ride_id", "cell", "event_time", "cnt")


@query("sql_tumble_count", with_views("rides") + """
SELECT time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM rides WHERE is_start GROUP BY ALL""")
def sql_tumble_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides started per hour (F14, second SQL string)."""
    _prepare(spark, sf_dir, "rides")
    return spark.sql("""
        SELECT window(event_time, '1 hour').end AS window_end, count(*) AS cnt
        FROM rides WHERE is_start GROUP BY window(event_time, '1 hour')""")


@query("sql_avg_duration", with_views("rides") + """
SELECT passenger_cnt, round(avg((epoch_us(end_time) - epoch_us(start_time)) / 60000000e0), 6) AS avg_minutes
FROM rides WHERE NOT is_start GROUP BY passenger_cnt""")
def sql_avg_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average ride duration in minutes by passenger count (F14, first SQL string)."""
    _prepare(spark, sf_dir, "rides")
    return spark.sql("""
        SELECT passenger_cnt,
               round(avg(timestampdiff(MICROSECOND, start_time, end_time) / 60000000D), 6) AS avg_minutes
        FROM rides WHERE NOT is_start GROUP BY passenger_cnt""")


@query("popular_places_sql", with_views("rides", dense=True) + f"""
, pts AS (
  SELECT CASE WHEN is_start THEN {D_CELL.format(lon="start_lon", lat="start_lat")}
              ELSE {D_CELL.format(lon="end_lon", lat="end_lat")} END AS cell, is_start, event_time FROM rides
  WHERE {D_IN_NYC.format(lon="start_lon", lat="start_lat")} AND {D_IN_NYC.format(lon="end_lon", lat="end_lat")}),
win AS (
  SELECT cell, is_start, time_bucket(INTERVAL '5 minutes', event_time) - k * INTERVAL '5 minutes' + INTERVAL '15 minutes'
         AS window_end FROM pts, range(0, 3) r(k))
SELECT {D_CLON.format(c="cell")} AS lon, {D_CLAT.format(c="cell")} AS lat, window_end, is_start, count(*) AS pop_cnt
FROM win GROUP BY cell, is_start, window_end HAVING count(*) > {POPULAR_THRESHOLD}""")
def popular_places_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding 15/5 min counts per (cell, is_start) in SQL with the registered grid
    functions, HAVING cnt > threshold (the SQL form uses '>', the stream '>=') (ST6, F7)."""
    _prepare(spark, sf_dir, "rides", dense=True)
    return spark.sql(f"""
        SELECT c.lon AS lon, c.lat AS lat, window_end, is_start, pop_cnt FROM (
          SELECT to_coords(cell) AS c, w.end AS window_end, is_start, count(*) AS pop_cnt FROM (
            SELECT CASE WHEN is_start THEN to_cell_id(start_lon, start_lat) ELSE to_cell_id(end_lon, end_lat) END AS cell,
                   is_start, window(event_time, '15 minutes', '5 minutes') AS w
            FROM rides WHERE is_in_nyc(start_lon, start_lat) AND is_in_nyc(end_lon, end_lat))
          GROUP BY cell, is_start, w HAVING count(*) > {POPULAR_THRESHOLD})""")


@query("date_functions", with_views("mails") + """
SELECT message_id, strftime(sent, '%Y-%m-%d %H:%M:%S') AS sent_text,
       timezone('America/Los_Angeles', sent AT TIME ZONE 'UTC') AS sent_los_angeles,
       epoch_us(sent) // 1000000 AS sent_epoch_s,
       strptime(strftime(sent, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed_back FROM mails""")
def date_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Format, parse, zone conversion and epoch seconds."""
    from pyspark.sql import functions as F

    from riverbed.sources.codecs import TIME_FORMAT
    from riverbed.functions.time import epoch_millis, utc_to_zone
    m = views.mails(spark, sf_dir)
    txt = F.date_format("sent", TIME_FORMAT)
    return m.select("message_id", txt.alias("sent_text"), utc_to_zone("sent", "America/Los_Angeles").alias("sent_los_angeles"),
                    F.floor(epoch_millis("sent") / 1000).cast("bigint").alias("sent_epoch_s"),
                    F.to_timestamp_ntz(txt, F.lit(TIME_FORMAT)).alias("parsed_back"))
