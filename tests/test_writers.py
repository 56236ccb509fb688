"""Writers of documents, points and sorted files: flush sizes, replays, order, null rows."""

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from riverbed.plans.codecs_io import point_line
from riverbed.plans.geo_places import popular_places_df
from riverbed.plans.stream_writers import index_places
from riverbed.session import scratch_path
from riverbed.sources import views
from riverbed.streaming.sinks import bucket_versions, latest_rows, lines_writer, upsert_writer, write_sorted_lines
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)
POINTS = "sensor_id long, temp double, ts timestamp_ntz"


def lines_of(path, batch):
    return [open(f).read().splitlines() for f in sorted(glob.glob(f"{path}/batch_id={batch}/part-*"))]


def test_points_are_flushed_in_tens_and_replaced(spark):
    path = scratch_path(spark, "points-test")
    write = lines_writer(path, point_line(), 10)
    rows = spark.createDataFrame([(i, i / 2, T0 + dt.timedelta(seconds=i)) for i in range(25)], POINTS).coalesce(1)
    write(rows, 0)
    write(rows, 0)  # delivered again
    write(spark.createDataFrame([(7, 1.5, T0), (None, 1.0, T0), (1, None, T0), (1, 1.0, None)], POINTS), 1)
    write(spark.createDataFrame([], POINTS), 2)
    assert sorted(len(f) for f in lines_of(path, 0)) == [5, 10, 10]
    assert [x for f in lines_of(path, 1) for x in f] == ["temperature,key=7 value=1.5 1704067200000"]
    assert spark.read.text(path).count() == 26


def test_sorted_files_hold_the_order(spark):
    path = scratch_path(spark, "sorted-test")
    df = spark.range(0, 5000, 1, 6).select(((F.col("id") * 7919) % 5000).alias("n"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")  # so few rows would go into one file
    try:
        write_sorted_lines(df, ["n"], F.col("n").cast("string"), path)
    finally:
        spark.conf.set(coalesce, before)
    files = sorted(glob.glob(f"{path}/part-*"))
    assert len(files) > 1
    assert [int(x) for f in files for x in open(f).read().split()] == list(range(5000))
    with pytest.raises(Exception):
        write_sorted_lines(df, ["n"], F.col("n").cast("string"), path)  # a written file stays


def test_index_holds_one_document_per_place(spark):
    path = scratch_path(spark, "index-test")
    rides = views.rides(spark, SF_SMALL, dense=True).coalesce(2)
    index_places(rides, path, buckets=8)
    got = latest_rows(spark, path, "id string, cnt long, doc string").collect()
    want = popular_places_df(rides).count()
    assert len(got) == len({r.id for r in got}) == want > 0
    assert all(json.loads(r.doc)["cnt"] == str(r.cnt) for r in got)


def test_upsert_files_hold_at_most_a_flush(spark):
    path = scratch_path(spark, "flush-test")
    write = upsert_writer(path, "id", ["cnt"], ["doc"], buckets=2, flush_rows=10)
    write(spark.range(100).select(F.col("id").cast("string"), F.lit(1).cast("long").alias("cnt"), F.lit("d").alias("doc")), 0)
    sizes = [spark.read.parquet(f).count() for f in glob.glob(f"{path}/up_bucket=*/up_version=0/*.parquet")]
    assert sum(sizes) == 100 and max(sizes) == 10


def test_index_requests_are_rows_and_old_slots_stay(spark):
    """Requests of ten documents share a file; a batch of later times leaves the earlier documents' buckets alone."""
    path = scratch_path(spark, "requests-test")
    write = upsert_writer(path, "id", ["cnt"], ["doc"], buckets=2, slot=F.floor(F.col("id") / 100), request_rows=10)
    docs = lambda a, b, c: spark.range(a, b).select("id", F.lit(c).cast("long").alias("cnt"), F.lit("d").alias("doc"))
    write(docs(0, 105, 1), 0)
    write(docs(100, 200, 2), 1)
    write(docs(100, 200, 2), 1)  # delivered again
    got = {r.id: r.cnt for r in latest_rows(spark, path, "id long, cnt long, doc string").collect()}
    assert got == {i: 1 if i < 100 else 2 for i in range(200)}
    assert {b: sorted(v) for b, v in bucket_versions(spark, path).items() if b < 2} == {0: [0], 1: [0]}
    files = [f for f in glob.glob(f"{path}/up_bucket=*/up_version=*/*.parquet")]
    sizes = [[len(r[0]) for r in spark.read.parquet(f).select("up_request").collect()] for f in files]
    assert len(files) <= 6 and max(len(s) for s in sizes) > 3 and all(max(s) <= 10 for s in sizes)
