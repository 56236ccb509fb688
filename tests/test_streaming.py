"""Streaming twins equal their batch forms.

Each input table is staged as time-ordered files (one file per micro-batch),
a far-future flush row closes every window, and the sink's content is
compared with the batch operator on the same table."""

from pyspark.sql import functions as F

from riverbed.functions.time import to_instant, to_wall_clock
from riverbed.plans import alerts, cars_patterns, ride_state, tips
from riverbed.session import scratch_path
from riverbed.sources import views
from riverbed.streaming import twins
from riverbed.streaming.files import file_stream, flush_row, stage_files
from tests.conftest import SF_SMALL
from tools.oracle_check import canon_rows

N_FILES = 4


def _stream(spark, df, time_col, name, flush=None, to_instants=()):
    path = scratch_path(spark, name)
    stage_files(df, path, time_col, N_FILES)
    if flush is not None:
        flush_row(df, [c for c in df.columns if c in to_instants], **flush).write.mode("append").parquet(path)
    s = file_stream(spark, path, df.schema)
    for c in to_instants:
        s = s.withColumn(c, to_instant(c))
    return s


def _run(spark, sdf, name):
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    (sdf.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return spark.read.parquet(out)


def _same(a, b):
    pa, pb = a.toPandas(), b.toPandas()
    assert sorted(pa.columns) == sorted(pb.columns)
    assert len(pa) > 0
    assert canon_rows(pa) == canon_rows(pb)


def test_cleansing_stream(spark):
    r = views.rides(spark, SF_SMALL)
    got = _run(spark, twins.cleansing_stream(_stream(spark, r, "event_time", "clean")), "clean")
    from riverbed.plans.geo_places import cleansed
    _same(got, cleansed(r))


def test_enrich_stream(spark):
    r, f = views.rides(spark, SF_SMALL), views.fares(spark, SF_SMALL)
    ts = ("event_time", "start_time", "end_time")
    rs = _stream(spark, r, "event_time", "enr-r", flush={"ride_id": -1, "is_start": True}, to_instants=ts)
    fs = _stream(spark, f, "start_time", "enr-f", flush={"ride_id": -2}, to_instants=("start_time",))
    got = _run(spark, twins.enrich_stream(rs, fs), "enr")
    got = got.filter(F.col("ride_id") >= 0).withColumn("r_time", to_wall_clock("r_time")).withColumnRenamed(
        "r_time", "start_time")
    _same(got, ride_state.enriched(r, f))


def test_unmatched_stream(spark):
    r, f = views.rides(spark, SF_SMALL), views.fares(spark, SF_SMALL)
    ts = ("event_time", "start_time", "end_time")
    # the flush row must pass the query's filters: Catalyst pushes them below the watermark
    rs = _stream(spark, r, "event_time", "um-r", flush={"ride_id": -1, "is_start": True}, to_instants=ts)
    fs = _stream(spark, f, "start_time", "um-f", flush={"ride_id": -2}, to_instants=("start_time",))
    got = _run(spark, twins.unmatched_stream(rs, fs), "um").filter(
        F.coalesce("r_id", "f_id") >= 0)
    fares_only = got.filter(F.col("r_id").isNull()).select(F.col("f_id").alias("ride_id"))
    rides_only = got.filter(F.col("f_id").isNull()).select(F.col("r_id").alias("ride_id"))
    from riverbed.plans.ride_state import unmatched_fares, unmatched_rides
    _same(fares_only, unmatched_fares(spark, SF_SMALL).select("ride_id"))
    _same(rides_only, unmatched_rides(spark, SF_SMALL).select("ride_id"))


def test_sessions_stream(spark):
    c = views.cars(spark, SF_SMALL)
    cs = _stream(spark, c, "event_time", "sess", flush={"car_id": -1}, to_instants=("event_time",))
    got = _run(spark, twins.sessions_stream(cs), "sess").filter(F.col("car_id") >= 0)
    got = got.select("car_id", to_wall_clock("start_time").alias("start_time"), "length", "max_speed",
                     F.round("erraticness", 6).alias("erraticness"))
    want = cars_patterns.driving_sessions(spark, SF_SMALL).drop("label")
    _same(got, want)


def test_hourly_tips_max_stream(spark):
    f = views.fares(spark, SF_SMALL)
    fs = _stream(spark, f, "start_time", "tmax", flush={"driver_id": -1, "tip": 0.0}, to_instants=("start_time",))
    got = _run(spark, twins.hourly_tips_max_stream(fs), "tmax")
    got = got.select(to_wall_clock("window_end").alias("window_end"), "driver_id",
                     F.round("total_tips", 6).alias("total_tips")).filter(F.year("window_end") < 2200)
    _same(got, tips.hourly_tips_max_df(f))


def test_temp_jump_stream_transform_with_state(spark):
    s = views.sensors(spark, SF_SMALL)
    ss = _stream(spark, s, "ts", "jump")
    got = _run(spark, twins.temp_jump_stream(ss), "jump")
    _same(got, alerts.temp_jump_alerts(spark, SF_SMALL))


def _run_update(spark, sdf, name, key):
    """Update mode through foreachBatch; the newest emission per key is the table."""
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")

    def write(batch, batch_id):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b={batch_id}")
    (sdf.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).outputMode("update")
     .trigger(availableNow=True).start().awaitTermination())
    back = spark.read.parquet(out)
    cols = [c for c in back.columns if c not in (key, "_batch", "b")]
    return back.groupBy(key).agg(F.max_by(F.struct(*cols), "_batch").alias("r")).select(key, "r.*")


def test_lookup_stream(spark):
    s = views.sensors(spark, SF_SMALL)
    from riverbed.sources.tables import table
    rooms = table(spark, SF_SMALL, "customer").select(F.col("c_custkey").alias("sensor_id"), F.col("c_name").alias("room"))
    got = _run(spark, twins.lookup_stream(_stream(spark, s, "ts", "look"), rooms), "look")
    _same(got, alerts.lookup_enrich(spark, SF_SMALL))


def test_dedup_stream_drops_replayed_copies(spark):
    s = views.sensors(spark, SF_SMALL)
    doubled = s.unionByName(s)                      # every reading delivered twice
    ds = _stream(spark, doubled, "ts", "dedup", flush={"event_id": -1}, to_instants=("ts",))
    got = _run(spark, twins.dedup_stream(ds, ["event_id"], "ts"), "dedup").filter("event_id >= 0")
    _same(got.withColumn("ts", to_wall_clock("ts")), s)


def test_window_max_stream(spark):
    s = views.sensors(spark, SF_SMALL)
    ss = _stream(spark, s, "ts", "wmax", flush={"sensor_id": -1}, to_instants=("ts",))
    got = _run(spark, twins.window_max_stream(ss), "wmax").filter("sensor_id >= 0")
    from riverbed.plans.basics import window_max
    _same(got.withColumn("window_end", to_wall_clock("window_end")), window_max(spark, SF_SMALL))


def test_running_totals_update_mode(spark):
    s = views.sensors(spark, SF_SMALL)
    got = _run_update(spark, twins.running_totals_stream(_stream(spark, s, "ts", "tot")), "tot", "sensor_id")
    from riverbed.plans.basics import rolling_sum
    last = rolling_sum(spark, SF_SMALL).groupBy("sensor_id").agg(
        F.max_by("running_sum", "event_id").alias("running_sum"), F.max("event_id").alias("last_event_id"))
    _same(got.withColumn("running_sum", F.round("running_sum", 6)), last)


def test_latest_ride_update_mode(spark):
    r = views.rides(spark, SF_SMALL)
    got = _run_update(spark, twins.latest_ride_stream(_stream(spark, r, "event_time", "lat")), "lat", "taxi_id")
    _same(got, ride_state.latest_per_taxi(r).drop("start_time"))


def test_freezing_side_output_foreach_batch(spark):
    from riverbed.streaming.sinks import split_writer
    s = views.sensors(spark, SF_SMALL)
    main, side, ckpt = (scratch_path(spark, n) for n in ("fz-main", "fz-side", "fz-ckpt"))
    (_stream(spark, s, "ts", "fz").writeStream.foreachBatch(split_writer(main, side, F.col("temp") < 32.0))
     .option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination())
    _same(spark.read.parquet(main).drop("batch_id"), s)
    _same(spark.read.parquet(side).drop("batch_id"), s.filter(F.col("temp") < 32.0))


def test_asof_join_stream_with_timers(spark):
    from riverbed.functions.time import from_epoch_millis
    from riverbed.plans.alerts import asof_enrich, trades_customers
    from riverbed.streaming.processors import asof_join_stream
    trades, customers = trades_customers(spark, SF_SMALL)
    ev = trades.select("customer_id", F.lit("T").alias("kind"), "trade_id", F.col("trade_ts").alias("ts"),
                       F.lit(None).cast("string").alias("info")).unionByName(
        customers.select("customer_id", F.lit("C").alias("kind"), F.lit(None).cast("long").alias("trade_id"),
                         F.col("cust_ts").alias("ts"), F.col("customer_info").alias("info")))
    es = _stream(spark, ev, "ts", "asof", flush={"customer_id": -1, "kind": "C"}, to_instants=("ts",))
    got = _run(spark, asof_join_stream(es), "asof").select(
        "trade_id", "customer_id", from_epoch_millis("trade_ms").alias("trade_ts"), "customer_info",
        from_epoch_millis("matched_ms").alias("matched_at"))
    want = asof_enrich(spark, SF_SMALL).select(
        "trade_id", "customer_id", F.date_trunc("millisecond", "trade_ts").alias("trade_ts"), "customer_info",
        F.date_trunc("millisecond", "matched_at").alias("matched_at"))
    _same(got, want)


def test_over_range_count_stream(spark):
    from riverbed.functions import geo
    from riverbed.plans.sql_forms import sql_over_range_count
    from riverbed.streaming.processors import range_count_stream
    r = views.rides(spark, SF_SMALL)
    starts = r.filter(F.col("is_start") & geo.in_nyc("start_lon", "start_lat")).select(
        "ride_id", geo.grid_cell("start_lon", "start_lat").cast("long").alias("cell"), "event_time")
    ss = _stream(spark, starts, "event_time", "over", flush={"ride_id": -1, "cell": -1}, to_instants=("event_time",))
    got = _run(spark, range_count_stream(ss, "cell", "ride_id", "event_time", 10 * 60 * 1000), "over").filter("id >= 0")
    want = sql_over_range_count(spark, SF_SMALL)
    _same(got.select(F.col("id").alias("ride_id"), F.col("key").alias("cell"), "cnt"),
          want.select("ride_id", F.col("cell").cast("long").alias("cell"), "cnt"))


def test_heartbeat_sessions_stream(spark):
    from riverbed.functions.time import epoch_millis
    from riverbed.plans.heartbeats import instance_sessions
    from riverbed.streaming.processors import heartbeat_sessions_stream
    b = views.beats(spark, SF_SMALL).select("instance_id", "product_id", "customer_id", "event_id",
                                             F.floor(epoch_millis("ts") / 1000).alias("ts_s"), "ts")
    bs = _stream(spark, b, "ts", "beats").drop("ts")
    got = _run(spark, heartbeat_sessions_stream(bs), "beats")
    _same(got, instance_sessions(spark, SF_SMALL))


def test_travel_time_stream(spark):
    from riverbed.functions import geo
    from riverbed.functions.time import epoch_millis, minutes_between
    from riverbed.plans.geo_places import cleansed
    from riverbed.plans.travel import travel_time_prediction
    from riverbed.streaming.processors import travel_time_stream
    r = cleansed(views.rides(spark, SF_SMALL)).select(
        "ride_id", (~F.col("is_start")).alias("is_end"), "event_time", epoch_millis("event_time").alias("event_ms"),
        geo.grid_cell("end_lon", "end_lat").alias("cell"),
        (geo.direction("end_lon", "end_lat", "start_lon", "start_lat") / 45).cast("int").alias("bucket"),
        geo.distance("start_lon", "start_lat", "end_lon", "end_lat").alias("x"),
        F.coalesce(minutes_between("start_time", "end_time"), F.lit(0.0)).alias("y"))
    rs = _stream(spark, r, "event_time", "travel").drop("event_time")
    got = _run(spark, travel_time_stream(rs), "travel")
    _same(got, travel_time_prediction(spark, SF_SMALL))


def test_disordered_arrival_keeps_event_time_answers(spark):
    """Rows arrive up to 7 s out of event-time order (staged by arrival time);
    with a 10 s watermark delay the windowed answer equals the batch one."""
    from riverbed.plans.basics import window_max
    s = views.sensors(spark, SF_SMALL)
    arrived = s.withColumn("arrival", F.timestamp_add("MILLISECOND", (F.col("event_id") * 7919) % 7000, F.col("ts")))
    path = scratch_path(spark, "disorder")
    stage_files(arrived, path, "arrival", N_FILES)
    flush_row(arrived, ["ts", "arrival"], sensor_id=-1).write.mode("append").parquet(path)
    st = file_stream(spark, path, arrived.schema).drop("arrival").withColumn("ts", to_instant("ts"))
    got = _run(spark, twins.window_max_stream(st, delay="10 seconds"), "disorder").filter("sensor_id >= 0")
    _same(got.withColumn("window_end", to_wall_clock("window_end")), window_max(spark, SF_SMALL))


def test_late_rows_to_side_output(spark):
    """Late rows of a disordered stream land in the side output, computed with
    the batch-granular watermark (max of earlier micro-batches − delay).  The
    stream arrives as three thirds one after another (a partition replayed
    after the stream moved on), so most rows of the later thirds are late."""
    from riverbed.functions.time import epoch_millis
    from riverbed.streaming.sinks import late_split_writer
    s = views.sensors(spark, SF_SMALL)
    arrived = s.withColumn("arrival", F.timestamp_add("DAY", (F.col("event_id") % 3) * 40, F.col("ts")))
    path = scratch_path(spark, "late-src")
    files = stage_files(arrived, path, "arrival", 6)
    main, late, state, ckpt = (scratch_path(spark, n) for n in ("late-main", "late-side", "late-state", "late-ckpt"))
    delay = 500
    (file_stream(spark, path, arrived.schema).writeStream
     .foreachBatch(late_split_writer(main, late, state, "ts", delay)).option("checkpointLocation", ckpt)
     .trigger(availableNow=True).start().awaitTermination())
    # expected: file i is micro-batch i; its watermark is the max event time of files < i minus the delay
    want_late, top = [], None
    for f in files:
        part = spark.read.schema(arrived.schema).parquet(f).select("event_id", epoch_millis("ts").alias("ms")).toPandas()
        if top is not None:
            want_late += part.loc[part["ms"] < top - delay, "event_id"].tolist()
        top = max(top, int(part["ms"].max())) if top is not None else int(part["ms"].max())
    got_late = sorted(r.event_id for r in spark.read.parquet(late).select("event_id").collect())
    got_main = spark.read.parquet(main).count()
    assert want_late, "the staged disorder must produce late rows"
    assert got_late == sorted(want_late)
    assert got_main + len(got_late) == s.count()
