"""Streams that write what other queries only render: documents into an index kept by
id, time-series points as lines, trip events as sorted files; and a row-time table
that SQL text reads as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_millis, to_instant, to_wall_clock
from riverbed.plans.codecs_io import point_line
from riverbed.plans.geo_places import place_document, popular_places_df
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import oracle_sql_of, query
from riverbed.plans.ride_state import TRIPS_SQL, trips_to_events
from riverbed.session import scratch_path
from riverbed.sources import views
from riverbed.streaming.replay import FLUSH, by_volume, replay, volume_batches
from riverbed.streaming.sinks import latest_rows, lines_writer, upsert_writer, write_sorted_lines

# fixed value: actions between two flushes of the index writer
INDEX_FLUSH = 10
POINTS_FLUSH = 100_000


def index_places(rides: DataFrame, path: str, flush_rows: int = INDEX_FLUSH, buckets: int = 64) -> None:
    """Popular places of a ride table, streamed in update mode into an index of documents:
    a place whose count grew is sent again and replaces its document.  The index is cut by
    the batches' times, so a batch meets the documents of its own time and not all of them;
    a request to it holds at most ``flush_rows`` documents."""
    batch = volume_batches(rides, epoch_millis("event_time"))

    def build(s: DataFrame) -> DataFrame:
        s = s.withColumn("event_time", to_instant("event_time")).withWatermark("event_time", "60 seconds")
        p = popular_places_df(s)
        place = F.concat_ws("/", F.col("lon").cast("string"), F.col("lat").cast("string"), F.col("is_start").cast("string"),
                            epoch_millis("window_end").cast("string"))
        return p.select(place.alias("id"), "cnt", place_document().alias("doc"), epoch_millis("window_end").alias("end_ms"))

    replay(rides, batch(epoch_millis("event_time")), build, "places-index", mode="update",
           foreach=upsert_writer(path, "id", ["cnt"], ["doc"], buckets=buckets, slot=batch(F.col("end_ms")), request_rows=flush_rows))


@query("popular_places_index", oracle_sql_of("popular_places_json_docs"))
def popular_places_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO11 with its writer: the index's documents after the stream has ended."""
    path = scratch_path(spark, "places-index")
    index_places(views.rides(spark, sf_dir), path)
    return latest_rows(spark, path, "id string, cnt long, doc string").select("doc")


@query("timeseries_points_written", oracle_sql_of("timeseries_points"))
def timeseries_points_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO12 with its writer: points written as lines per micro-batch, read back."""
    path = scratch_path(spark, "points")
    s = views.sensors(spark, sf_dir)
    replay(s, by_volume(s, epoch_millis("ts")), lambda rows: rows.filter(~F.col(FLUSH)), "points",
           foreach=lines_writer(path, point_line(), POINTS_FLUSH))
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("trip_events_file", TRIPS_SQL + """
SELECT concat_ws(',', seq, 'START', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), '1970-01-01 00:00:00') AS line FROM trips
UNION ALL
SELECT concat_ws(',', seq, 'END', strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')) FROM trips""")
def trip_events_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SO2: the events of all trips written to files sorted by time, read back."""
    path = scratch_path(spark, "trip-events")
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    write_sorted_lines(trips_to_events(spark, sf_dir), ["event_time", "other_time", "seq"],
                       F.concat_ws(",", F.col("seq").cast("string"), "event_type", text("event_time"), text("other_time")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("sql_hourly_tips_streaming_view", with_views("fares", dense=True) + """
SELECT time_bucket(INTERVAL '1 hour', start_time) + INTERVAL '1 hour' AS window_end, driver_id,
       round(sum(tip), 6) AS total_tips
FROM fares GROUP BY ALL HAVING sum(tip) > 50e0""")
def sql_hourly_tips_streaming_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO18: fares as a streaming view with row time and watermark; the SQL text of
    ``sql_hourly_tips_having`` runs on it as a stream."""
    f = views.fares(spark, sf_dir, dense=True).select("driver_id", "start_time", "tip")

    def build(s: DataFrame) -> DataFrame:
        s.withColumn("start_time", to_instant("start_time")).withWatermark("start_time", "60 seconds").createOrReplaceTempView(
            "fares_by_row_time")
        return spark.sql(f"""
            SELECT window.end AS window_end, driver_id, {FLUSH}, round(sum(tip), 6) AS total_tips FROM fares_by_row_time
            GROUP BY window(start_time, '1 hour'), driver_id, {FLUSH} HAVING sum(tip) > 50 OR {FLUSH}""")

    out, _ = replay(f, by_volume(f, epoch_millis("start_time")), build, "fares-view", flush_time="start_time")
    return out.select(to_wall_clock("window_end").alias("window_end"), "driver_id", "total_tips")
