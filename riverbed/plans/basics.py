"""Sensor-reading queries: filters, projections, rolling and windowed aggregates.

``events`` is read as a sensor stream: ``sensor_id`` = user_id, ``temp`` = value.
Arrival order, where the reference depends on it, is ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros
from riverbed.operators.running import join_back, running_max_before, running_sum, volume_chunk
from riverbed.operators.windows import tumbling_agg
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views

SV = with_views("sensors")


@query("filter_threshold", SV + "SELECT event_id, sensor_id, ts, temp FROM sensors WHERE temp >= 25e0")
def filter_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sensors(spark, sf_dir).filter(F.col("temp") >= 25.0)


@query("project_ids", SV + "SELECT sensor_id FROM sensors")
def project_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.sensors(spark, sf_dir).select("sensor_id")


@query("flatmap_split", SV + """
SELECT event_id, CAST(generate_subscripts(arr, 1) - 1 AS BIGINT) AS pos, unnest(arr) AS part
FROM (SELECT event_id, string_split('sensor_' || sensor_id, '_') AS arr FROM sensors)""")
def flatmap_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = views.sensors(spark, sf_dir)
    name = F.concat(F.lit("sensor_"), F.col("sensor_id").cast("string"))
    return s.select("event_id", F.posexplode(F.split(name, "_")).alias("pos", "part")).select(
        "event_id", F.col("pos").cast("bigint").alias("pos"), "part")


@query("split_by_predicate", SV + """
SELECT event_id, sensor_id, temp, CASE WHEN temp < 5e0 THEN 'print' ELSE 'special' END AS tag FROM sensors""")
def split_by_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two complementary filters tagged with constants, done as one pass."""
    s = views.sensors(spark, sf_dir)
    return s.select("event_id", "sensor_id", "temp", F.when(F.col("temp") < 5.0, "print").otherwise("special").alias("tag"))


@query("convert_units", SV + "SELECT event_id, sensor_id, ts, (temp - 32e0) * (5e0 / 9e0) AS temp_c FROM sensors")
def convert_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = views.sensors(spark, sf_dir)
    return s.select("event_id", "sensor_id", "ts", ((F.col("temp") - 32) * (5.0 / 9.0)).alias("temp_c"))


@query("rolling_sum", SV + """
SELECT event_id, sensor_id, temp,
       round(sum(temp) OVER (PARTITION BY sensor_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), 6) AS running_sum
FROM sensors""")
def rolling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sensor, the sum of all readings so far, one output per reading (A1)."""
    s = views.sensors(spark, sf_dir).select("event_id", "sensor_id", "temp")
    r = running_sum(s, ["sensor_id"], ["event_id"], volume_chunk(s, F.col("event_id")), F.col("temp"), "running_sum")
    return r.withColumn("running_sum", F.round("running_sum", 6))


@query("rolling_reduce_max", SV + """
SELECT event_id, sensor_id, max(ts) OVER w AS max_ts, first_value(temp) OVER w AS temp
FROM sensors WINDOW w AS (PARTITION BY sensor_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)""")
def rolling_reduce_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling reduce: newest timestamp so far, temperature of the key's first reading (A2)."""
    s = views.sensors(spark, sf_dir).select("event_id", "sensor_id", "ts", "temp")
    r = running_max_before(s, ["sensor_id"], ["event_id"], volume_chunk(s, F.col("event_id")), F.col("ts"), "before")
    first = s.groupBy("sensor_id").agg(F.min_by("temp", "event_id").alias("first_temp"))
    return join_back(r, first, ["sensor_id"]).select(
        "event_id", "sensor_id", F.greatest("before", "ts").alias("max_ts"), F.col("first_temp").alias("temp"))


@query("high_temp_counts", SV + """
SELECT event_id, sensor_id,
  CAST(sum(CASE WHEN temp > 100e0 THEN 1 ELSE 0 END) OVER (PARTITION BY sensor_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS key_count,
  CAST(sum(CASE WHEN temp > 100e0 THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_count
FROM sensors""")
def high_temp_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count of readings above 100 per sensor and over all sensors.

    The all-sensor count is a prefix sum with no key: done by chunks cut by volume
    and chunk offsets, never a single-partition window over the detail rows.
    """
    s = views.sensors(spark, sf_dir).select("event_id", "sensor_id", "ts", "temp")
    hot = F.when(F.col("temp") > 100.0, 1).otherwise(0).cast("bigint")
    chunk = volume_chunk(s, epoch_micros("ts"))
    r = running_sum(s, ["sensor_id"], ["ts", "event_id"], chunk, hot, "key_count")
    r = running_sum(r, [], ["ts", "event_id"], chunk, hot, "total_count")
    return r.select("event_id", "sensor_id", "key_count", "total_count")


@query("tumbling_avg", SV + """
SELECT time_bucket(INTERVAL '1 second', ts) + INTERVAL '1 second' AS window_end, sensor_id,
       round(avg((temp - 32e0) * (5e0 / 9e0)), 6) AS avg_temp
FROM sensors GROUP BY ALL""")
def tumbling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """°F→°C, then 1 s tumbling average per sensor; result time = window end (ST5)."""
    s = views.sensors(spark, sf_dir).withColumn("temp_c", (F.col("temp") - 32) * (5.0 / 9.0))
    w = tumbling_agg(s, "ts", "1 second", ["sensor_id"], {"avg_temp": F.avg("temp_c")})
    return w.select("window_end", "sensor_id", F.round("avg_temp", 6).alias("avg_temp"))


@query("window_avg", SV + """
SELECT time_bucket(INTERVAL '15 seconds', ts) AS window_start, sensor_id, round(avg(temp), 6) AS avg_temp
FROM sensors GROUP BY ALL""")
def window_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15 s average per sensor; the key is kept (A10)."""
    w = tumbling_agg(views.sensors(spark, sf_dir), "ts", "15 seconds", ["sensor_id"], {"avg_temp": F.avg("temp")})
    return w.select("window_start", "sensor_id", F.round("avg_temp", 6).alias("avg_temp"))


@query("window_min_max", SV + """
SELECT sensor_id, min(temp) AS min_temp, max(temp) AS max_temp,
       time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end
FROM sensors GROUP BY sensor_id, time_bucket(INTERVAL '5 seconds', ts)""")
def window_min_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min/max pair per sensor and 5 s window, stamped with the window end."""
    w = tumbling_agg(views.sensors(spark, sf_dir), "ts", "5 seconds", ["sensor_id"],
                     {"min_temp": F.min("temp"), "max_temp": F.max("temp")})
    return w.select("sensor_id", "min_temp", "max_temp", "window_end")


@query("window_max", SV + """
SELECT sensor_id, time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end, max(temp) AS max_temp
FROM sensors GROUP BY ALL""")
def window_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sensor 10 s maximum."""
    w = tumbling_agg(views.sensors(spark, sf_dir), "ts", "10 seconds", ["sensor_id"], {"max_temp": F.max("temp")})
    return w.select("sensor_id", "window_end", "max_temp")


@query("window_all_sum", SV + """
SELECT time_bucket(INTERVAL '2 seconds', ts) AS window_start, round(sum(temp), 6) AS sum_temp,
       arg_min(sensor_id, event_id) AS first_sensor_id
FROM sensors WHERE temp < 5e0 GROUP BY ALL""")
def window_all_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Un-keyed 2 s sum of low readings, with a field of the window's first row."""
    s = views.sensors(spark, sf_dir).filter(F.col("temp") < 5.0)
    w = tumbling_agg(s, "ts", "2 seconds", [], {"sum_temp": F.sum("temp"),
                                                "first_sensor_id": F.min_by("sensor_id", "event_id")})
    return w.select("window_start", F.round("sum_temp", 6).alias("sum_temp"), "first_sensor_id")


@query("window_all_avg", SV + """
SELECT strftime(time_bucket(INTERVAL '1 second', ts) + INTERVAL '1 second', '%Y-%m-%dT%H:%M:%S') AS window_end_text,
       round(avg(temp), 6) AS avg_temp
FROM sensors GROUP BY time_bucket(INTERVAL '1 second', ts)""")
def window_all_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Un-keyed 1 s average, stamped with the ISO text of the window end."""
    w = tumbling_agg(views.sensors(spark, sf_dir), "ts", "1 second", [], {"avg_temp": F.avg("temp")})
    return w.select(F.date_format("window_end", "yyyy-MM-dd'T'HH:mm:ss").alias("window_end_text"),
                    F.round("avg_temp", 6).alias("avg_temp"))


@query("custom_tumbling_count", SV + """
SELECT sensor_id, time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end, count(*) AS cnt
FROM sensors GROUP BY ALL""")
def custom_tumbling_count(spark: SparkSession, sf_dir: str, size: str = "10 seconds") -> DataFrame:
    """Count per sensor in fixed windows whose size is a parameter (ST11)."""
    w = tumbling_agg(views.sensors(spark, sf_dir), "ts", size, ["sensor_id"], {"cnt": F.count(F.lit(1))})
    return w.select("sensor_id", "window_end", "cnt")


@query("latest_max_lookup", SV + """
, w AS (SELECT sensor_id, time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end,
               max(temp) AS max_temp FROM sensors GROUP BY ALL)
SELECT sensor_id, arg_max(window_end, window_end) AS window_end, arg_max(max_temp, window_end) AS max_temp
FROM w GROUP BY sensor_id""")
def latest_max_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per sensor, the maximum of its newest 10 s window — the value an outside
    point lookup reads (ST24, re-aimed from queryable state to a keyed table)."""
    w = window_max(spark, sf_dir)
    best = F.max_by(F.struct("window_end", "max_temp"), F.col("window_end"))
    return w.groupBy("sensor_id").agg(best.alias("b")).select("sensor_id", "b.window_end", "b.max_temp")
