"""Readers for the parquet tables.

Every reader returns a lazy scan; callers select only the columns they need so
Catalyst prunes the parquet ``ReadSchema`` and pushes filters into the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Temp views for the SQL forms (``sql_*`` queries)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
