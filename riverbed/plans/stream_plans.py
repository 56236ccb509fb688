"""Structured Streaming twins, registered as queries: each stages its whole input
table as time-ordered files, runs the streaming job to completion
(``availableNow``) and returns what the sink holds, so the driver compares the
streamed answer with the same SQL oracle as the batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import from_epoch_millis, to_instant, to_wall_clock
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.session import scratch_path
from riverbed.sources import views
from riverbed.streaming.files import file_stream, files_per_trigger, flush_row, stage_files
from riverbed.streaming.processors import FLUSH, long_rides_stream
from riverbed.streaming.sinks import latest_rows, replay_safe_writer, upsert_writer

#: Least time ranges, and so micro-batches, of a staged table.
N_FILES = 4


def _staged_stream(spark: SparkSession, df: DataFrame, time_col: str, name: str, flush: list[dict] | None = None,
                   times: tuple[str, ...] = ()):
    """``df`` staged as a stream.  With ``flush``, rows carry ``_flush``, true on the last
    rows, far in the future, that move the watermark past all others."""
    path = scratch_path(spark, f"{name}-src")
    if flush is not None:
        df = df.withColumn(FLUSH, F.lit(False))
    at_once = files_per_trigger(spark, stage_files(df, path, time_col, N_FILES), N_FILES)
    for values in flush or []:
        flush_row(df, [time_col, *times], **values, **{FLUSH: True}).write.mode("append").parquet(path)
    return file_stream(spark, path, df.schema, at_once)


def _real(df: DataFrame) -> DataFrame:
    """Rows of the table, whatever their keys, without the flush rows."""
    return df.filter(~F.col(FLUSH)).drop(FLUSH)


def _run(sdf: DataFrame, spark: SparkSession, name: str, mode: str = "append", foreach=None) -> str:
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    w = sdf.writeStream.option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True)
    if foreach is not None:
        w = w.foreachBatch(foreach(out))
    else:
        w = w.format("parquet").option("path", out)
    w.start().awaitTermination()
    return out


@query("long_rides_stream", with_views("rides") + """
SELECT ride_id, date_trunc('millisecond', start_time) AS start_time FROM rides s WHERE s.is_start AND NOT EXISTS (
  SELECT 1 FROM rides e WHERE NOT e.is_start AND e.ride_id = s.ride_id AND e.event_time <= s.start_time + INTERVAL '2 hours')""")
def long_rides_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST18 as a stream: keyed state + event-time timeouts (applyInPandasWithState).
    A final far-future END, marked as such, closes every timer."""
    r = views.rides(spark, sf_dir).select("ride_id", "is_start", "event_time")
    s = _staged_stream(spark, r, "event_time", "long-rides", flush=[{"is_start": False}])
    s = s.withColumn("event_time", to_instant("event_time"))
    out = _run(long_rides_stream(s), spark, "long-rides")
    return _real(spark.read.parquet(out)).select("ride_id", from_epoch_millis("start_ms").alias("start_time"))


@query("hourly_tips_stream", with_views("fares") + """
SELECT time_bucket(INTERVAL '1 hour', start_time) AS window_start,
       time_bucket(INTERVAL '1 hour', start_time) + INTERVAL '1 hour' AS window_end,
       driver_id, round(sum(tip), 6) AS total_tips
FROM fares GROUP BY ALL""")
def hourly_tips_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11/ST5 as a stream: watermark 1 min, tumbling hour per driver, append mode."""
    f = views.fares(spark, sf_dir).select("driver_id", "start_time", "tip")
    s = _staged_stream(spark, f, "start_time", "tips", flush=[{}])
    s = s.withColumn("start_time", to_instant("start_time")).withWatermark("start_time", "1 minute")
    agg = s.groupBy(F.window("start_time", "1 hour"), "driver_id", FLUSH).agg(F.sum("tip").alias("total_tips"))
    out = _run(agg.select(F.col("window.start").alias("ws"), F.col("window.end").alias("we"), "driver_id", FLUSH, "total_tips"),
               spark, "tips")
    return _real(spark.read.parquet(out)).select(to_wall_clock("ws").alias("window_start"), to_wall_clock("we").alias("window_end"), "driver_id",
                      F.round("total_tips", 6).alias("total_tips"))


@query("upsert_latest", with_views("sensors") + """
SELECT sensor_id, ts, event_id, temp FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY ts DESC, event_id DESC) AS rn FROM sensors) WHERE rn = 1""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO13: idempotent keyed upsert of the newest reading per sensor, batch by
    batch, in buckets by key; the table is read ordered by its key (SO3)."""
    s = views.sensors(spark, sf_dir).select("event_id", "sensor_id", "ts", "temp")
    st = _staged_stream(spark, s, "ts", "upsert")
    out = _run(st, spark, "upsert", foreach=lambda p: upsert_writer(p, "sensor_id", ["ts", "event_id"], ["temp"]))
    return latest_rows(spark, out, s.schema).select("sensor_id", "ts", "event_id", "temp").orderBy("sensor_id")


@query("replay_safe_sink", with_views("sensors") + "SELECT event_id, sensor_id, ts, temp FROM sensors")
def replay_safe_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IO14/IO15: every batch written under its batch id with overwrite; batch 0 is
    then delivered a second time (as after a failure) and must not duplicate."""
    s = views.sensors(spark, sf_dir).select("event_id", "sensor_id", "ts", "temp")
    path = scratch_path(spark, "replay-src")
    files = stage_files(s, path, "ts", N_FILES)
    st = file_stream(spark, path, s.schema)
    out = _run(st, spark, "replay", foreach=replay_safe_writer)
    replay_safe_writer(out)(spark.read.schema(s.schema).parquet(files[0]), 0)
    return spark.read.parquet(out).select("event_id", "sensor_id", "ts", "temp")


@query("cep_long_rides_stream", with_views("rides") + """
SELECT * FROM rides s WHERE s.is_start AND NOT EXISTS (
  SELECT 1 FROM rides e WHERE NOT e.is_start AND e.ride_id = s.ride_id
  AND e.event_time < s.start_time + INTERVAL '2 hours')""")
def cep_long_rides_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST17 as a built-in stream-stream left outer join: a START meets its END
    only if the END comes within two hours; once the watermark passes that
    bound Spark emits the START with a null partner — the timed-out pattern.
    JVM-side state, no Python.  A marked START and a marked END at a far time move
    both sides' watermarks (each side's filter is pushed below its watermark)."""
    r = views.rides(spark, sf_dir)
    times = ["event_time", "start_time", "end_time"]
    s = _staged_stream(spark, r, "event_time", "cep", flush=[{"is_start": True}, {"is_start": False}], times=("start_time", "end_time"))
    for c in times:
        s = s.withColumn(c, to_instant(c))
    s = s.withWatermark("event_time", "1 minute")
    starts = s.filter("is_start")
    ends = s.filter(~F.col("is_start")).select(F.col("ride_id").alias("e_id"), F.col("event_time").alias("e_time"))
    cond = ((F.col("ride_id") == F.col("e_id")) & (F.col("e_time") >= F.col("event_time"))
            & (F.col("e_time") < F.col("event_time") + F.expr("INTERVAL 2 HOURS")))
    timed_out = starts.join(ends, cond, "left_outer").filter(F.col("e_id").isNull()).drop("e_id", "e_time")
    out = _run(timed_out, spark, "cep")
    back = _real(spark.read.parquet(out))
    return back.select(*[to_wall_clock(c).alias(c) if c in times else F.col(c) for c in r.columns])
