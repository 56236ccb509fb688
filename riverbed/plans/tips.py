"""Hourly tips (tumbling window + two-level aggregation + max-by)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.operators.windows import top1_per_group, tumbling_agg
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views


def hourly_tips_df(fares: DataFrame) -> DataFrame:
    """Per driver and hour: sum of tips (A11/ST5)."""
    return tumbling_agg(fares, "start_time", "1 hour", ["driver_id"], {"total_tips": F.sum("tip")})


def hourly_tips_max_df(fares: DataFrame) -> DataFrame:
    """Per hour: the driver with the most tips (A13/ST10); ties → smaller driver id."""
    per_driver = hourly_tips_df(fares)
    best = top1_per_group(per_driver, ["window_end"], "total_tips", "driver_id", ["driver_id", "total_tips"])
    return best.select("window_end", "driver_id", F.round("total_tips", 6).alias("total_tips"))


@query("hourly_tips", with_views("fares") + """
SELECT time_bucket(INTERVAL '1 hour', start_time) AS window_start,
       time_bucket(INTERVAL '1 hour', start_time) + INTERVAL '1 hour' AS window_end,
       driver_id, round(sum(tip), 6) AS total_tips
FROM fares GROUP BY ALL""")
def hourly_tips(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hourly_tips_df(views.fares(spark, sf_dir))
    return h.withColumn("total_tips", F.round("total_tips", 6))


@query("hourly_tips_max", with_views("fares") + """
, per AS (SELECT time_bucket(INTERVAL '1 hour', start_time) + INTERVAL '1 hour' AS window_end, driver_id,
                 sum(tip) AS total_tips FROM fares GROUP BY ALL)
SELECT window_end, driver_id, round(total_tips, 6) AS total_tips FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY total_tips DESC, driver_id) AS rn FROM per)
WHERE rn = 1""")
def hourly_tips_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_tips_max_df(views.fares(spark, sf_dir))
