"""Replay of a table as a stream whose micro-batches are known, and reads of the
keyed state that such a job leaves behind.

Each batch is appended to the source folder by its own write, whole, while the
job is stopped; the job is then started on its checkpoint and takes everything
new as one micro-batch.  The order so hangs neither on file names nor on file
times, a batch has as many files as its writer has tasks, and every batch is a
restart from the checkpoint.  Rows carry ``_flush``: true marks the row far in the
future that moves the watermark past all others; queries carry the column to their
output and leave such rows out there, so real rows of any key, null too, stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.session import ROCKSDB_PROVIDER, scratch_path
from riverbed.streaming.files import BATCH_ROWS

FLUSH = "_flush"
FAR = "2200-01-01 00:00:00"
#: Rows of a whole table for which a job gets one state partition.  Every batch opens and
#: commits each partition's store, however few rows it has there.
STATE_ROWS = 1_000_000
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"


def replay(df: DataFrame, batch: Column, build: Callable[[DataFrame], DataFrame], name: str, flush_time: str | None = None,
           mode: str = "append", foreach: Callable[[DataFrame, int], None] | None = None,
           idle_batches: bool = True) -> tuple[DataFrame | None, str]:
    """Run ``build`` over ``df`` as a stream, one micro-batch per value of ``batch``
    in rising order, and return what its file sink holds and the checkpoint.

    ``flush_time`` names the time column of a last row, all else null, that closes
    every window.  In update mode the rows go nowhere: the state is the result; with
    ``foreach`` they go where that batch writer puts them.  Without ``idle_batches`` a
    watermark that a batch has moved closes its windows in the next batch, and only after the
    last one in a batch without rows.  That halves the batches and gives the same rows where
    batches follow event time; a late row would be judged by an older watermark."""
    spark = df.sparkSession
    conf = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(conf, "") != ROCKSDB_PROVIDER:
        spark.conf.set(conf, ROCKSDB_PROVIDER)
    staged, src = scratch_path(spark, f"{name}-staged"), scratch_path(spark, f"{name}-src")
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    rows = df.withColumn(FLUSH, F.lit(False))
    rows.withColumn("_batch", batch.cast("long")).write.partitionBy("_batch").parquet(staged)
    held = spark.read.schema(f"{_ddl(rows)}, _batch long").parquet(staged)
    numbers = sorted(r[0] for r in held.select("_batch").distinct().collect())
    steps = [held.filter(F.col("_batch") == n).drop("_batch") for n in numbers]
    if flush_time is not None:
        last = [F.lit(FAR).cast(t).alias(c) if c == flush_time else F.lit(c == FLUSH if c == FLUSH else None).cast(t).alias(c)
                for c, t in rows.dtypes]
        steps.append(spark.range(1).select(*last))
    confs = {"spark.sql.shuffle.partitions": str(state_partitions(spark, held.count()))}
    before = {c: spark.conf.get(c) for c in [*confs, NO_DATA]}
    try:
        for i, step in enumerate(steps):
            step.write.mode("append").parquet(src)
            if not idle_batches:
                confs[NO_DATA] = str(i == len(steps) - 1).lower()
            for c, v in confs.items():
                spark.conf.set(c, v)
            stream = build(spark.readStream.schema(rows.schema).parquet(src))
            writer = stream.writeStream.option("checkpointLocation", ckpt).outputMode(mode).trigger(availableNow=True)
            if foreach is not None:
                writer = writer.foreachBatch(foreach)
            else:
                writer = writer.format("noop") if mode == "update" else writer.format("parquet").option("path", out)
            writer.start().awaitTermination()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    if mode == "update" or foreach is not None:
        return None, ckpt
    back = spark.read.parquet(out)
    return (back.filter(~F.col(FLUSH)).drop(FLUSH) if FLUSH in back.columns else back), ckpt


def state_partitions(spark: SparkSession, rows: int) -> int:
    """State partitions of a job over ``rows`` rows: one for every ``STATE_ROWS``, at least
    one a core, and no more than the session's shuffles have."""
    least = max(spark.sparkContext.defaultParallelism, -(-rows // STATE_ROWS))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), least)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def by_volume(df: DataFrame, time_ms: Column, least: int = 4) -> Column:
    """Batch numbers for ``replay``: consecutive time ranges of about equal size, one for
    every ``BATCH_ROWS`` rows, at least ``least``.  Not one for every split of the input: a
    union or a larger cluster has more of these for the same rows, and a batch costs its
    start however few rows it has.  A count and an aggregate give the bounds."""
    return volume_batches(df, time_ms, least)(time_ms)


def volume_batches(df: DataFrame, time_ms: Column, least: int = 4) -> Callable[[Column], Column]:
    """``by_volume`` as a function, for other times on the same scale."""
    n = max(least, -(-df.count() // BATCH_ROWS))
    bounds = df.select(F.percentile_approx(time_ms, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    return lambda ms: F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < ms)) if bounds else F.lit(0)


def state(spark: SparkSession, checkpoint: str, variable: str | None = None) -> DataFrame:
    """``key, value, partition_id`` that the last batch of a job left in its state."""
    reader = spark.read.format("statestore").option("path", checkpoint)
    return (reader.option("stateVarName", variable) if variable else reader).load()


def state_of_key(spark: SparkSession, checkpoint: str, key: Column) -> DataFrame:
    """The state of one key (a literal of the key column's type), from the state
    partition that holds it: rows are dealt by hash, so the other partitions
    aren't opened."""
    meta = spark.read.format("state-metadata").load(checkpoint).select("numPartitions", "maxBatchId").first()
    part = spark.range(1).select(F.pmod(F.hash(key), F.lit(meta[0]))).first()[0]
    rows = (spark.read.format("statestore").option("path", checkpoint).option("snapshotStartBatchId", meta[1])
            .option("snapshotPartitionId", part).option("batchId", meta[1]).load())
    return rows.filter(F.col(f"key.`{rows.schema['key'].dataType.names[0]}`") == key)
