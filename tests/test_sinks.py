"""The keyed upsert touches the buckets of a batch's keys only; a marker watermark is kept per batch."""

import glob
import os

from pyspark.sql import functions as F

from riverbed.session import scratch_path
from riverbed.streaming.sinks import bucket_versions, late_split_writer, latest_rows, upsert_writer

SCHEMA = "id long, at long, v string"


def held(spark, path):
    return sorted((tuple(r) for r in latest_rows(spark, path, SCHEMA).select("id", "at", "v").collect()), key=str)


def size(path, batch):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/up_bucket=*/up_version={batch}/*.parquet"))


def test_upsert_by_buckets(spark):
    path = scratch_path(spark, "upsert-test")
    write = upsert_writer(path, "id", ["at"], ["v"], buckets=32)
    assert held(spark, path) == []
    write(spark.range(20000).select("id", F.lit(1).cast("long").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("v")), 0)
    few = spark.createDataFrame([(5, 2, "new"), (6, 0, "old"), (None, 1, "no key"), (None, 3, "no key, newer")], SCHEMA)
    write(few, 1)
    want = held(spark, path)
    rows = {r[0]: r for r in want}
    assert len(want) == 20001 and rows[5] == (5, 2, "new") and rows[6][1] == 1 and rows[None] == (None, 3, "no key, newer")
    # bytes follow the batch: three of 32 buckets
    assert 0 < size(path, 1) < size(path, 0) / 5
    assert sum(1 in v for v in bucket_versions(spark, path).values()) <= 3
    write(few, 1)  # delivered again
    assert held(spark, path) == want
    write(spark.createDataFrame([], SCHEMA), 2)
    write(spark.createDataFrame([(5, 3, "newest")], SCHEMA), 3)
    assert (5, 3, "newest") in held(spark, path) and len(held(spark, path)) == 20001
    # at most the version read and the one written stay
    assert max(len(v) for v in bucket_versions(spark, path).values()) == 2


def test_marker_watermark(spark):
    """Only markers move the watermark; a batch delivered again writes the same rows to the same side."""
    main, late, state = (scratch_path(spark, n) for n in ("main", "late", "state"))
    write = late_split_writer(main, late, state, "ts", 1000, marker=F.col("mark"))
    rows = lambda *r: spark.createDataFrame([*r], "id int, s double, mark boolean").select(
        "id", "mark", F.timestamp_add("MILLISECOND", (F.col("s") * 1000).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"))
    batches = [rows((1, 10.0, True), (2, 500.0, False)), rows((3, 8.0, False), (4, 9.0, False), (5, None, False)),
               rows((6, 20.0, True), (7, 8.9, True)), rows((8, 18.0, False), (9, 19.5, None))]
    for i in (0, 1, 1, 2, 3, 3):
        write(batches[i], i)
    assert {r.id for r in spark.read.parquet(late).collect()} == {3, 7, 8}
    assert {r.id for r in spark.read.parquet(main).collect()} == {1, 2, 4, 5, 6, 9}
