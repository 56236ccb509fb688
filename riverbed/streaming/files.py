"""File-backed streams: stage a table as time-ordered files, read it back as a
stream, run a query to completion (``availableNow``) into a parquet sink.

Everything lives under the shared checkpoint folder (``spark.checkpoint.dir``)
so a restarted driver or a lost executor resumes from the query checkpoint.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import to_instant
from riverbed.session import scratch_path

#: Rows of a micro-batch, about; they are spread over the state's partitions.
BATCH_ROWS = 4_000_000


def stage_files(df: DataFrame, path: str, time_col: str, least_files: int) -> list[str]:
    """Write ``df`` under ``path`` as consecutive time ranges, one file a range, so a
    file source reading one file per trigger replays the table in event-time order.

    One range shuffle and one parallel write: as many ranges as the input has
    splits, so files grow in number and not in size, and at least
    ``least_files``.  A file source takes files by modification time; the
    files' times are set in the order of their ranges, a second apart and before
    now (metadata only).  Returns the data files in that order."""
    spark = df.sparkSession
    before = set(_data_files(spark, path))
    ranges = max(least_files, df.rdd.getNumPartitions())
    df.repartitionByRange(ranges, time_col).write.mode("append").parquet(path)
    # part-<range>-<job>-c<n>: by range, then by file of the range
    new = sorted(set(_data_files(spark, path)) - before,
                 key=lambda f: (int(f.rsplit("/", 1)[1].split("-")[1]), f))
    begin = (int(time.time()) - len(new)) * 1000
    for i, f in enumerate(new):
        p = spark._jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(p, begin + 1000 * i, -1)
    return new


def files_per_trigger(spark: SparkSession, files: list[str], least_batches: int) -> int:
    """How many of the staged ``files``, in their order, make a micro-batch: about
    ``BATCH_ROWS`` rows, but at least ``least_batches`` batches of all.  A batch so is read
    by many tasks, and batches grow in number with the rows and not with the splits."""
    batches = max(least_batches, -(-spark.read.parquet(*files).count() // BATCH_ROWS))
    return max(1, len(files) // batches)


def _data_files(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [str(st.getPath()) for st in fs.listStatus(p) if st.getPath().getName().endswith(".parquet")]


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
            .parquet(path))


def as_event_time(df: DataFrame, *cols: str) -> DataFrame:
    """Watermarks need ``TIMESTAMP``; staged tables carry UTC wall clock (NTZ)."""
    for c in cols:
        df = df.withColumn(c, to_instant(c))
    return df


def flush_row(df: DataFrame, time_cols: list[str], **values) -> DataFrame:
    """One row far in the future: staged last, it moves the watermark past every
    real row so append-mode results are complete (the tests' final watermark).

    The row must pass every filter of the query: Catalyst pushes filters on
    non-time columns below ``withWatermark``, so a filtered-out row never
    reaches the watermark operator."""
    first = df.limit(1)
    sel = []
    for f in df.schema.fields:
        if f.name in time_cols:
            sel.append(F.lit("2200-01-01 00:00:00").cast(f.dataType).alias(f.name))
        elif f.name in values:
            sel.append(F.lit(values[f.name]).cast(f.dataType).alias(f.name))
        else:
            sel.append(F.col(f.name))
    return first.select(*sel)
