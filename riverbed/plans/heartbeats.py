"""Heartbeat sessions (ST14): time between consecutive newer heartbeats per
(instance, product, customer), and per product the session time summed over
10 s periods opened by the product's first session row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_millis
from riverbed.operators.running import join_back, running_max_before, volume_chunk
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views

KEYS = ["instance_id", "product_id", "customer_id"]
PERIOD_S = 10

SESSIONS_SQL = with_views("beats") + """
, b AS (SELECT *, epoch_us(ts) // 1000000 AS ts_s FROM beats),
m AS (SELECT *, max(ts_s) OVER (PARTITION BY instance_id, product_id, customer_id ORDER BY event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max FROM b),
acc AS (SELECT * FROM m WHERE prev_max IS NULL OR ts_s > prev_max),
d AS (SELECT *, lag(ts_s) OVER (PARTITION BY instance_id, product_id, customer_id ORDER BY event_id) AS prev_ts FROM acc),
sessions AS (SELECT instance_id, product_id, customer_id, event_id, ts_s, ts_s - prev_ts AS session_s
             FROM d WHERE prev_ts IS NOT NULL)
"""


def instance_sessions_df(beats: DataFrame) -> DataFrame:
    """Heartbeats in arrival order (event id); a beat not newer than the newest
    seen so far is ignored; each accepted beat after the first yields the time
    since the previous accepted one, in seconds."""
    # A beat is accepted exactly when it raises the key's maximum, so the
    # previous accepted beat is the running maximum of all earlier beats: one
    # chunked running max, no second pass over the accepted rows.
    chunk = volume_chunk(beats, F.col("event_id"))
    b = beats.withColumn("ts_s", F.floor(epoch_millis("ts") / 1000))
    b = running_max_before(b, KEYS, ["event_id"], chunk, F.col("ts_s"), "prev_max")
    return b.filter(F.col("prev_max").isNotNull() & (F.col("ts_s") > F.col("prev_max"))).select(
        *KEYS, "event_id", "ts_s", (F.col("ts_s") - F.col("prev_max")).alias("session_s"))


@query("instance_sessions", SESSIONS_SQL + "SELECT * FROM sessions")
def instance_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return instance_sessions_df(views.beats(spark, sf_dir))


@query("product_session_time", SESSIONS_SQL + f"""
, f AS (SELECT product_id, min(ts_s) AS first_s FROM sessions GROUP BY product_id)
SELECT s.product_id, f.first_s + {PERIOD_S} * ((s.ts_s - f.first_s) // {PERIOD_S}) AS period_start_s,
       CAST(sum(s.session_s) AS BIGINT) AS total_session_s
FROM sessions s JOIN f USING (product_id) GROUP BY ALL""")
def product_session_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per product, session seconds summed over 10 s periods that start at the
    product's first session row (the timer 10 s after the first, re-armed)."""
    return product_periods(instance_sessions_df(views.beats(spark, sf_dir)))


def product_periods(s: DataFrame) -> DataFrame:
    """``instance_sessions_df`` summed per product and period; a null product is a product."""
    first = s.groupBy("product_id").agg(F.min("ts_s").alias("first_s"))
    p = join_back(s, first, ["product_id"]).withColumn(
        "period_start_s", F.col("first_s") + PERIOD_S * F.floor((F.col("ts_s") - F.col("first_s")) / PERIOD_S))
    return p.groupBy("product_id", "period_start_s").agg(F.sum("session_s").cast("bigint").alias("total_session_s"))
