"""Replay-safe sinks built on ``foreachBatch``.

A micro-batch can be delivered again after a failure (same ``batch_id``), so
every writer here is idempotent per batch id:

* ``replay_safe_writer``: each batch overwrites its own ``batch_id=N`` folder —
  a replay replaces the first copy instead of adding a second (IO14, IO15).
* ``upsert_writer``: keyed upsert (IO13).  The batch is reduced to its newest
  row per key (``max_by``, a partial aggregate) and merged with the buckets that
  hold its keys; other buckets aren't touched.
* ``lines_writer``: text lines in flushes of a set number (IO12); ``upsert_writer``, which
  holds documents by id, has requests of a set number (IO11).
* ``split_writer``: main output plus side output by a predicate (ST22, ST8).
"""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REQUEST = "up_request"


def replay_safe_writer(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
    return write


def lines_writer(path: str, line: Column, flush_rows: int):
    """Each batch as text files of at most ``flush_rows`` lines in a folder of its own,
    which a batch delivered again replaces.  A row without a line is left out."""
    def write(batch: DataFrame, batch_id: int) -> None:
        lines = batch.select(line.alias("value")).filter("value IS NOT NULL")
        lines.write.mode("overwrite").option("maxRecordsPerFile", flush_rows).text(os.path.join(path, f"batch_id={batch_id}"))
    return write


def write_sorted_lines(df: DataFrame, order: list[str], line: Column, path: str) -> None:
    """Text files whose names, in their order, hold the lines sorted by ``order``: ranges
    are cut by a sample, so a file is a range and none holds everything (SO2)."""
    df.orderBy(*order).select(line.alias("value")).write.mode("error").text(path)


def upsert_writer(path: str, key: str, order: list[str], value_cols: list[str], buckets: int = 64, flush_rows: int = 0,
                  slot: Column | None = None, request_rows: int = 0):
    """Newest row per ``key`` by ``order`` across all batches, in ``buckets`` by hash of the key.

    ``slot``, a number from 0 that follows from the key, gives each of its values buckets of
    their own: with slots of time a batch in time order doesn't touch what older ones wrote.

    A batch reads and writes only the buckets that hold its keys, each as a new version
    named by the batch (``up_bucket=B/up_version=N``), so its bytes follow the batch and not the table.
    ``flush_rows`` bounds the rows of a file (0: no bound).  With ``request_rows`` the rows of a
    bucket go out in requests of at most so many: a row of a file is a request, and holds its
    rows as an array, so files grow with the buckets and not with the requests.
    A replayed batch reads the versions before its own and replaces its own.  A bucket's
    versions before the one just read go once the new one is written."""
    cols = [*order, *value_cols]

    def newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("up_bucket", key).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r")).select("up_bucket", key, "r.*")

    def write(batch: DataFrame, batch_id: int) -> None:
        # kept for the two passes over it, or a stateful batch would be worked out twice
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
        bucket = bucket if slot is None else (F.coalesce(slot, F.lit(0)) * buckets + bucket).cast("int")
        mine = newest(batch.withColumn("up_bucket", bucket)).persist()
        try:
            merge(mine, batch_id)
        finally:
            mine.unpersist()

    def merge(mine: DataFrame, batch_id: int) -> None:
        spark = mine.sparkSession
        # at most ``buckets`` numbers a slot
        touched = {r[0] for r in mine.select("up_bucket").distinct().collect()}
        if not touched:
            return
        held = {b: [v for v in vs if v < batch_id] for b, vs in bucket_versions(spark, path, touched).items()}
        old = [f"{path}/up_bucket={b}/up_version={max(vs)}" for b, vs in sorted(held.items()) if vs]
        if old:
            before = _single_rows(spark.read.option("basePath", path).parquet(*old))
            mine = newest(mine.unionByName(before.select(*mine.columns)))
        mine = mine.repartition("up_bucket")
        if request_rows:
            number = F.floor((F.row_number().over(Window.partitionBy("up_bucket").orderBy(key)) - 1) / request_rows)
            rows = F.collect_list(F.struct(key, *cols)).alias(REQUEST)
            mine = mine.withColumn("_n", number).groupBy("up_bucket", "_n").agg(rows).drop("_n")
        (mine.withColumn("up_version", F.lit(batch_id)).write.partitionBy("up_bucket", "up_version").mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", flush_rows).parquet(path))
        for b, vs in held.items():
            for v in sorted(vs)[:-1]:
                fs, p = _fs(spark, f"{path}/up_bucket={b}/up_version={v}")
                fs.delete(p, True)
    return write


def _single_rows(held: DataFrame) -> DataFrame:
    """Rows as they came, out of requests too."""
    return held.select("up_bucket", "up_version", F.inline(REQUEST)) if REQUEST in held.columns else held


def bucket_versions(spark, path: str, buckets: Iterable[int] | None = None) -> dict[int, list[int]]:
    """Versions held of each bucket (of all, or of ``buckets``), from the folder's names."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    found: dict[int, list[int]] = {}
    for b in ["*"] if buckets is None else buckets:
        for st in fs.globStatus(_fs(spark, f"{path}/up_bucket={b}/up_version=*")[1]) or []:
            f = st.getPath()
            found.setdefault(int(f.getParent().getName().split("=")[1]), []).append(int(f.getName().split("=")[1]))
    return found


def _fs(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _exists(spark, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def latest_rows(spark, path: str, schema) -> DataFrame:
    """The newest version of every bucket that ``upsert_writer`` holds; no rows before its first batch."""
    live = [f"{path}/up_bucket={b}/up_version={max(vs)}" for b, vs in sorted(bucket_versions(spark, path).items())]
    held = _single_rows(spark.read.option("basePath", path).parquet(*live)) if live else spark.createDataFrame([], schema)
    return held.drop("up_bucket", "up_version")


def split_writer(main_path: str, side_path: str, predicate):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(main_path, f"batch_id={batch_id}"))
        batch.filter(predicate).write.mode("overwrite").parquet(os.path.join(side_path, f"batch_id={batch_id}"))
    return write


def late_split_writer(main_path: str, late_path: str, state_path: str, ts_col: str, delay_ms: int, marker=None):
    """ST8 on a stream: rows behind the watermark go to a side output instead of
    being dropped.  The watermark is batch-granular like Spark's own: the
    largest event time of all earlier micro-batches minus ``delay_ms``, kept as
    a one-row snapshot per batch id (``v=N``) in the shared folder, so a
    replayed batch reads the same watermark and rewrites the same outputs.
    With ``marker`` (a condition) only rows that hold it move the watermark (ST3)."""
    from riverbed.functions.time import epoch_millis

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev_path = os.path.join(state_path, f"v={batch_id - 1}")
        prev = spark.read.parquet(prev_path).first()["max_ms"] if batch_id > 0 and _exists(spark, prev_path) else None
        ms = epoch_millis(ts_col)
        # a row without a time is never late
        late = F.coalesce(ms < F.lit(prev - delay_ms), F.lit(False)) if prev is not None else F.lit(False)
        batch.filter(~late).write.mode("overwrite").parquet(os.path.join(main_path, f"batch_id={batch_id}"))
        batch.filter(late).write.mode("overwrite").parquet(os.path.join(late_path, f"batch_id={batch_id}"))
        top = batch.agg(F.max(ms if marker is None else F.when(marker, ms)).alias("m")).first()["m"]
        new = max((v for v in (prev, top) if v is not None), default=None)
        spark.createDataFrame([(new,)], "max_ms long").write.mode("overwrite").parquet(
            os.path.join(state_path, f"v={batch_id}"))
    return write
