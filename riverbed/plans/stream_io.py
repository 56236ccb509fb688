"""Streaming sources and sinks: message-topic decode/encode (over file streams,
the connector jar being absent), the exactly-once file sink across a restart,
resuming from a checkpoint with state, and update-mode output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions import geo
from riverbed.functions.time import epoch_millis, to_instant, to_wall_clock
from riverbed.plans.codecs_io import RIDES_BACK_SQL
from riverbed.plans.geo_places import POPULAR_SQL, popular_places_df
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.plans.stream_plans import N_FILES, _real, _run, _staged_stream
from riverbed.session import scratch_path
from riverbed.sources import codecs, views
from riverbed.streaming.files import file_stream, files_per_trigger, flush_row, stage_files
from riverbed.streaming.processors import FLUSH


def _topic_messages(rides: DataFrame) -> DataFrame:
    """Rides as topic records: UTF-8 CSV line as the binary value, event time as
    the record timestamp (the columns a message-topic source delivers)."""
    return rides.select(F.encode(codecs.ride_to_line(rides), "UTF-8").alias("value"),
                        F.col("event_time").alias("timestamp"))


@query("topic_decode_popular", POPULAR_SQL + "SELECT * FROM popular")
def topic_decode_popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO9: records read from the earliest offset, decoded, 60 s bounded disorder,
    then popular places on the decoded stream (sliding 15/5 min, append mode)."""
    r = views.rides(spark, sf_dir)
    # an in-box START at Penn Station: it survives the cleansing filter (which
    # Catalyst pushes below the watermark) and stays below the popularity threshold
    flush = flush_row(r, ["event_time", "start_time"], ride_id=0, is_start=True,
                      start_lon=-73.9947, start_lat=40.750626, end_lon=-73.9947, end_lat=40.750626)
    msgs = _staged_stream(spark, _topic_messages(r.unionByName(flush)), "timestamp", "topic-popular")
    rides = codecs.parse_ride_lines(msgs.select(F.decode("value", "UTF-8").alias("value")))
    rides = rides.withColumn("event_time", to_instant(
        F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time"))))
    rides = rides.withWatermark("event_time", "60 seconds")
    p = popular_places_df(rides)
    out = _run(p, spark, "topic-popular")
    back = spark.read.parquet(out)
    return back.select("lon", "lat", to_wall_clock("window_end").alias("window_end"), "is_start", "cnt")


@query("topic_encode_cleansed", RIDES_BACK_SQL + """
WHERE start_lon BETWEEN -74.05e0 AND -73.7e0 AND start_lat BETWEEN 40.5e0 AND 41.0e0
  AND end_lon BETWEEN -74.05e0 AND -73.7e0 AND end_lat BETWEEN 40.5e0 AND 41.0e0""")
def topic_encode_cleansed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO10: cleansed rides encoded as message values and written to a transport
    (a parquet folder of binary values here); read back and decoded."""
    r = views.rides(spark, sf_dir)
    s = _staged_stream(spark, r, "event_time", "topic-clean")
    clean = s.filter(geo.in_nyc("start_lon", "start_lat") & geo.in_nyc("end_lon", "end_lat"))
    out = _run(clean.select(F.encode(codecs.ride_to_line(clean), "UTF-8").alias("value")), spark, "topic-clean")
    back = spark.read.parquet(out).select(F.decode("value", "UTF-8").alias("value"))
    return codecs.parse_ride_lines(back)


def _window_avg_stream(s: DataFrame) -> DataFrame:
    s = s.withColumn("ts", to_instant("ts")).withWatermark("ts", "5 seconds")
    return s.groupBy(F.window("ts", "1 second"), FLUSH).agg(F.avg("temp").alias("avg_temp")).select(
        F.col("window.end").alias("we"), FLUSH, "avg_temp")


@query("transactional_file_sink", with_views("sensors") + """
SELECT strftime(time_bucket(INTERVAL '1 second', ts) + INTERVAL '1 second', '%Y-%m-%dT%H:%M:%S') AS window_end_text,
       round(avg(temp), 6) AS avg_temp
FROM sensors GROUP BY time_bucket(INTERVAL '1 second', ts)""")
def transactional_file_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO14: un-keyed 1 s averages into the exactly-once file sink; the query is
    then started again on the same checkpoint and sink, and must add nothing."""
    s = views.sensors(spark, sf_dir).select("ts", "temp", F.lit(False).alias(FLUSH))
    flush = flush_row(s, ["ts"], **{FLUSH: True})
    path = scratch_path(spark, "txn-src")
    at_once = files_per_trigger(spark, stage_files(s, path, "ts", N_FILES), N_FILES)
    flush.write.mode("append").parquet(path)
    out, ckpt = scratch_path(spark, "txn-out"), scratch_path(spark, "txn-ckpt")
    for _ in range(2):   # second start: restart after completion, nothing new to commit
        q = (_window_avg_stream(file_stream(spark, path, s.schema, at_once)).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    back = _real(spark.read.parquet(out))
    return back.select(F.date_format(to_wall_clock("we"), "yyyy-MM-dd'T'HH:mm:ss").alias("window_end_text"),
                       F.round("avg_temp", 6).alias("avg_temp"))


@query("restart_resume", with_views("fares") + """
SELECT time_bucket(INTERVAL '1 hour', start_time) + INTERVAL '1 hour' AS window_end, driver_id,
       round(sum(tip), 6) AS total_tips
FROM fares GROUP BY ALL""")
def restart_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO17/ST26: the job runs on the first half of the input and stops; the rest
    arrives; the job restarts from its checkpoint — file offsets and window
    state — and the final output equals one uninterrupted run."""
    f = views.fares(spark, sf_dir).select("driver_id", "start_time", "tip", F.lit(False).alias(FLUSH))
    mid = f.select(F.percentile_approx(epoch_millis("start_time"), 0.5, 10000)).first()[0]
    first, rest = f.filter(epoch_millis("start_time") < mid), f.filter(epoch_millis("start_time") >= mid)
    path = scratch_path(spark, "resume-src")
    out, ckpt = scratch_path(spark, "resume-out"), scratch_path(spark, "resume-ckpt")

    def run(files: list[str]) -> None:
        at_once = files_per_trigger(spark, files, N_FILES // 2)
        s = file_stream(spark, path, f.schema, at_once).withColumn("start_time", to_instant("start_time"))
        agg = (s.withWatermark("start_time", "1 minute")
               .groupBy(F.window("start_time", "1 hour"), "driver_id", FLUSH).agg(F.sum("tip").alias("total_tips")))
        q = (agg.select(F.col("window.end").alias("we"), "driver_id", FLUSH, "total_tips").writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()

    run(stage_files(first, path, "start_time", N_FILES // 2))
    files = stage_files(rest, path, "start_time", N_FILES // 2)
    flush_row(f, ["start_time"], **{FLUSH: True}).write.mode("append").parquet(path)
    run(files)
    back = _real(spark.read.parquet(out))
    return back.select(to_wall_clock("we").alias("window_end"), "driver_id", F.round("total_tips", 6).alias("total_tips"))


def _update_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


@query("output_modes", with_views("rides") + """
SELECT time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM rides GROUP BY ALL""")
def output_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO21: rides per hour in update mode — every micro-batch re-emits the
    windows it changed (the retract/upsert stream of the table program); the
    newest emission per window is the table."""
    r = views.rides(spark, sf_dir).select("ride_id", "event_time")
    s = _staged_stream(spark, r, "event_time", "modes").withColumn("event_time", to_instant("event_time"))
    agg = s.withWatermark("event_time", "1 hour").groupBy(F.window("event_time", "1 hour")).agg(
        F.count(F.lit(1)).alias("cnt")).select(F.col("window.end").alias("we"), "cnt")
    out = _run(agg, spark, "modes", mode="update", foreach=_update_writer)
    back = spark.read.parquet(out)
    latest = back.groupBy("we").agg(F.max_by("cnt", "batch_id").alias("cnt"))
    return latest.select(to_wall_clock("we").alias("window_end"), "cnt")


@query("output_modes_complete", with_views("rides") + """
SELECT time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM rides GROUP BY ALL""")
def output_modes_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO21 in complete mode: every micro-batch emits the whole table anew; the last one is it."""
    r = views.rides(spark, sf_dir).select("ride_id", "event_time")
    s = _staged_stream(spark, r, "event_time", "complete").withColumn("event_time", to_instant("event_time"))
    agg = s.groupBy(F.window("event_time", "1 hour")).agg(F.count(F.lit(1)).alias("cnt")).select(
        F.col("window.end").alias("we"), "cnt")
    out = _run(agg, spark, "complete", mode="complete", foreach=_update_writer)
    back = spark.read.parquet(out)
    last = back.agg(F.max("batch_id")).first()[0]
    return back.filter(F.col("batch_id") == last).select(to_wall_clock("we").alias("window_end"), "cnt")
