"""Streams whose state is the point: state read after the job, allowed lateness,
rules and rows in one keyed state, early firing (each replayed in known
micro-batches, see ``streaming.replay``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import (epoch_micros, epoch_millis, from_epoch_micros, from_epoch_millis, minutes_between,
                                     to_instant, to_wall_clock)
from riverbed.plans import alerts, basics, ride_state, rules  # noqa: F401  (their SQL is shared)
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import oracle_sql_of, query
from riverbed.sources import views
from riverbed.sources.tables import table
from riverbed.streaming.keyed_state import (KEY, early_fire_stream, expiring_jump_stream, held_rule_stream, late_window_stream,
                                             retry_join_stream, switch_stream, threshold_stream)
from riverbed.operators.late import disordered_arrival
from riverbed.session import scratch_path
from riverbed.streaming.replay import FLUSH, by_volume, replay, state, state_of_key
from riverbed.streaming.sinks import late_split_writer


def latest_ride_checkpoint(rides: DataFrame) -> str:
    """Run the keyed job that holds every taxi's newest ride event; its checkpoint."""
    order = F.struct("event_time", (~F.col("is_start")).alias("is_end"), "ride_id")
    best = F.max_by(F.struct("ride_id", "is_start", "event_time", "start_time"), order)
    rows = rides.select("taxi_id", "ride_id", "is_start", "event_time", "start_time")
    _, ckpt = replay(rows, by_volume(rows, epoch_millis("event_time")),
                     lambda s: s.groupBy("taxi_id").agg(best.alias("b")), "latest-ride", mode="update")
    return ckpt


@query("ongoing_rides_state", oracle_sql_of("ongoing_rides"))
def ongoing_rides_state(spark: SparkSession, sf_dir: str, minutes: int = ride_state.ONGOING_MINUTES) -> DataFrame:
    """ST23: all keys of a job's state are scanned for rides under way.  The job keeps
    each taxi's newest event; its state is read where the job left it, and the
    newest event time in it is the watermark."""
    held = state(spark, latest_ride_checkpoint(views.rides(spark, sf_dir)))
    value = held.schema["value"].dataType.names[0]
    latest = held.select(F.col("key.taxi_id").alias("taxi_id"), F.col(f"value.`{value}`.*"))
    now = latest.agg(F.max("event_time")).first()[0]
    mins = minutes_between(F.col("start_time"), F.lit(now).cast("timestamp_ntz"))
    return latest.filter("is_start").filter(mins >= minutes).select(
        "taxi_id", "ride_id", "start_time", F.round(mins, 6).alias("minutes_ongoing"))


def latest_max_checkpoint(readings: DataFrame) -> str:
    """Run the keyed job that holds the maximum of every sensor's newest 10 s window."""
    rows = readings.select("sensor_id", "ts", "temp")
    end = F.floor(epoch_millis("ts") / 10_000) * 10_000 + 10_000
    _, ckpt = replay(rows, by_volume(rows, epoch_millis("ts")), lambda s: s.groupBy("sensor_id").agg(
        F.max(F.struct(end.cast("long").alias("end_ms"), "temp")).alias("top")), "latest-max", mode="update")
    return ckpt


def _latest_max(held: DataFrame) -> DataFrame:
    value = held.schema["value"].dataType.names[0]
    return held.select(F.col("key.sensor_id").alias("sensor_id"), from_epoch_millis(f"value.{value}.end_ms").alias("window_end"),
                       F.col(f"value.{value}.temp").alias("max_temp"))


@query("latest_max_state", oracle_sql_of("latest_max_lookup"))
def latest_max_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST24: the value an outside reader finds in the job's state, for all keys."""
    return _latest_max(state(spark, latest_max_checkpoint(views.sensors(spark, sf_dir))))


@query("latest_max_of_key", oracle_sql_of("latest_max_lookup") + " HAVING sensor_id = (SELECT max(sensor_id) FROM sensors)")
def latest_max_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST24 as a point lookup: the sensor with the highest id, asked of the one state
    partition that holds it."""
    s = views.sensors(spark, sf_dir)
    sensor = s.agg(F.max("sensor_id")).first()[0]
    return _latest_max(state_of_key(spark, latest_max_checkpoint(s), F.lit(sensor).cast("long")))


# readings of the whole table brought close together: half a second of the table is a millisecond here
DENSE, DISORDER_MS, BATCHES = 500, 60_000, 4
DENSE_SQL = f"""
, dense AS (SELECT event_id, user_id, event_type, user_id % 5 AS key, CAST(floor(epoch_ms(ts) / {DENSE}e0) AS BIGINT) AS ms FROM events),
arr AS (SELECT *, ms + (event_id * 7919) % {DISORDER_MS} AS arrival_ms FROM dense),
batch AS (SELECT *, (arrival_ms - min(arrival_ms) OVER ()) * {BATCHES} // (max(arrival_ms) OVER () - min(arrival_ms) OVER () + 1) AS b FROM arr),
tops AS (SELECT b, max(max(ms)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {alerts.DISORDER_MS} AS wm_ms
         FROM batch GROUP BY b),
tagged AS (SELECT *, (ms // {alerts.WIN_MS} + 1) * {alerts.WIN_MS} AS end_ms, coalesce(wm_ms, 0) AS wm FROM batch JOIN tops USING (b)),
kind AS (SELECT *, end_ms <= wm AS late, end_ms + {alerts.LATENESS_MS} <= wm AS gone FROM tagged)
"""


def dense_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its time divided by ``DENSE``, arriving up to ``DISORDER_MS`` after it."""
    ev = table(spark, sf_dir, "events")
    ms = F.floor(epoch_millis("ts") / DENSE).cast("long")
    return ev.select("event_id", "user_id", "event_type", from_epoch_millis(ms).alias("ts"),
                     (ms + (F.col("event_id") * 7919) % DISORDER_MS).alias("arrival_ms"))


def arrival_batch(rows: DataFrame) -> Column:
    """``BATCHES`` micro-batches of equal arrival time."""
    low, high = rows.agg(F.min("arrival_ms"), F.max("arrival_ms")).first()
    return F.expr(f"(arrival_ms - {low or 0}) * {BATCHES} div {(high or 0) - (low or 0) + 1}")


@query("late_updates_stream", with_views("sensors") + DENSE_SQL + """
, fires AS (
  SELECT key, end_ms, 0 AS k, count(*) AS cnt FROM kind WHERE NOT late GROUP BY ALL
  UNION ALL
  SELECT key, end_ms, row_number() OVER (PARTITION BY key, end_ms ORDER BY b, arrival_ms, event_id) AS k,
    (SELECT count(*) FROM kind o WHERE NOT o.late AND o.key = t.key AND o.end_ms = t.end_ms)
    + row_number() OVER (PARTITION BY key, end_ms ORDER BY b, arrival_ms, event_id) AS cnt
  FROM kind t WHERE late AND NOT gone)
SELECT key, make_timestamp(end_ms * 1000) AS window_end, CAST(cnt AS BIGINT) AS cnt,
  CASE WHEN row_number() OVER (PARTITION BY key, end_ms ORDER BY k) = 1 THEN 'first' ELSE 'update' END AS mark FROM fires
UNION ALL SELECT key, make_timestamp(end_ms * 1000), 1, 'dropped' FROM kind WHERE gone""")
def late_updates_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST9 as a stream: 10 s windows that live 5 s past their end, fire at their end
    and for each late row within those 5 s; rows behind them are dropped, and shown
    as such.  The arrivals come in four micro-batches of equal time."""
    rows = dense_arrivals(spark, sf_dir).withColumn("key", F.col("user_id") % 5)

    def build(s: DataFrame) -> DataFrame:
        s = s.withColumn("ts", to_instant("ts"))
        return late_window_stream(s, f"{alerts.DISORDER_MS} milliseconds", alerts.WIN_MS, alerts.LATENESS_MS)

    out, _ = replay(rows, arrival_batch(rows), build, "late-updates", flush_time="ts")
    return out.select("key", from_epoch_millis("end_ms").alias("window_end"), "cnt", "mark")


@query("arrival_enrich_retry", with_views("sensors") + DENSE_SQL + """
, tops2 AS (SELECT b, max(max(ms)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 5000 AS wm_ms
          FROM batch WHERE event_type IN ('purchase', 'view') GROUP BY b),
u AS (SELECT batch.*, event_type = 'purchase' AS is_trade, coalesce(wm_ms, 0) AS wm FROM batch JOIN tops2 USING (b)
      WHERE event_type IN ('purchase', 'view')),
first_ask AS (
  SELECT t.event_id, t.user_id, t.ms, t.b, t.wm, (SELECT arg_max(c.event_id, (c.arrival_ms, c.event_id)) FROM u c
    WHERE NOT c.is_trade AND c.user_id = t.user_id AND (c.arrival_ms, c.event_id) < (t.arrival_ms, t.event_id)) AS cust
  FROM u t WHERE is_trade),
due AS (SELECT f.*, (SELECT min(b) FROM tops2 WHERE wm_ms >= f.ms) AS due_b FROM first_ask f WHERE cust IS NULL AND ms > wm),
second_ask AS (
  SELECT d.event_id, d.user_id, (SELECT arg_max(c.event_id, (c.arrival_ms, c.event_id)) FROM u c
    WHERE NOT c.is_trade AND c.user_id = d.user_id AND (d.due_b IS NULL OR c.b < d.due_b)) AS cust FROM due d)
SELECT user_id AS customer_id, event_id AS trade_id, 'info-' || cust AS customer_info, 'at once' AS answered
FROM first_ask WHERE cust IS NOT NULL
UNION ALL SELECT user_id, event_id, 'info-' || cust, 'waited' FROM second_ask
UNION ALL SELECT user_id, event_id, NULL, 'late' FROM first_ask WHERE cust IS NULL AND ms <= wm""")
def arrival_enrich_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 with its second try: trades meet the customer row that arrived last; a trade
    without one waits for the watermark to reach its time and asks again."""
    rows = dense_arrivals(spark, sf_dir).filter(F.col("event_type").isin("purchase", "view")).select(
        F.col("user_id").alias("customer_id"), "ts", "arrival_ms", "event_id", (F.col("event_type") == "purchase").alias("is_trade"),
        F.concat(F.lit("info-"), F.col("event_id").cast("string")).alias("info"))
    batch = arrival_batch(dense_arrivals(spark, sf_dir))
    out, _ = replay(rows, batch, lambda s: retry_join_stream(
        s.withColumn("ts", to_instant("ts")), f"{alerts.DISORDER_MS} milliseconds"), "retry", flush_time="ts")
    return out


@query("dynamic_threshold_stream", oracle_sql_of("dynamic_threshold_alerts"))
def dynamic_threshold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9, U7 as a stream: rule updates and readings of a sensor meet in one keyed state."""
    s, t = views.sensors(spark, sf_dir), views.thresholds(spark, sf_dir)
    both = s.select("sensor_id", epoch_micros("ts").alias("ts_us"), F.lit(1).alias("is_row"), F.col("event_id").alias("seq"),
                    F.col("temp").cast("double").alias("value")).unionByName(
        t.select(F.col("id").alias("sensor_id"), epoch_micros("set_at").alias("ts_us"), F.lit(0).alias("is_row"),
                 F.col("rule_id").alias("seq"), F.col("threshold").cast("double").alias("value")))
    out, _ = replay(both, by_volume(both, F.col("ts_us")), lambda r: threshold_stream(r, alerts.DEFAULT_THRESHOLD), "thresholds")
    return out


@query("active_alert_stream", oracle_sql_of("active_alert_filter"))
def active_alert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J14 as a stream: rules and clicks of a key meet in one keyed state; a rule
    that arrives while another is held is lost, and a timer ends the held one."""
    none = F.lit(None).cast("long")
    c = rules.entity_clicks(views.clicks(spark, sf_dir)).select(
        *KEY, "ts", F.lit(1).alias("is_row"), F.col("event_id").alias("seq"), none.alias("end_us"))
    r = views.alert_rules(spark, sf_dir).filter("begin_ts is not null and end_ts is not null").select(
        "client_id", F.col("entity_type_id").cast("int").alias("entity_type_id"), "entity_id", F.col("begin_ts").alias("ts"),
        F.lit(0).alias("is_row"), F.col("alert_use_id").alias("seq"), epoch_micros("end_ts").alias("end_us"))
    both = c.select("client_id", "entity_type_id", F.col("entity_id").cast("long").alias("entity_id"), "ts", "is_row", "seq",
                    "end_us").unionByName(r.withColumn("entity_id", F.col("entity_id").cast("long")))
    out, _ = replay(both, by_volume(both, epoch_micros("ts")),
                    lambda s: held_rule_stream(s.withColumn("ts", to_instant("ts"))), "active-alerts", flush_time="ts")
    return out.select("event_id", "entity_type_id", from_epoch_micros("ts_us").alias("ts"), "client_id", "alert_use_id")


@query("early_fire_stream", oracle_sql_of("early_fire_counts"))
def early_fire_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST13 as a stream: windows fired each second by timers that renew themselves,
    and purged at their end."""
    s = views.sensors(spark, sf_dir).select("sensor_id", "ts")
    out, _ = replay(s, by_volume(s, epoch_millis("ts")), lambda r: early_fire_stream(
        r.withColumn("ts", to_instant("ts")), rules.FIRE_WINDOW_S * 1000), "early-fire", flush_time="ts")
    return out.select("sensor_id", from_epoch_millis("end_ms").alias("window_end"),
                      from_epoch_millis("tick_ms").alias("tick"), "cnt")


def _readings(s: DataFrame) -> DataFrame:
    return s.select("sensor_id", "ts", F.lit(1).alias("is_row"), F.col("event_id").alias("seq"), F.col("temp").cast("double").alias("value"))


@query("switch_forward_stream", oracle_sql_of("switch_forward"))
def switch_forward_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J16 as a stream: switch events open a sensor's gate for an hour, a timer closes it."""
    switches = alerts.switch_events(spark, sf_dir).select(
        "sensor_id", F.col("switch_ts").alias("ts"), F.lit(0).alias("is_row"), F.lit(None).cast("long").alias("seq"),
        F.lit(None).cast("double").alias("value"))
    both = _readings(views.sensors(spark, sf_dir)).unionByName(switches)
    out, _ = replay(both, by_volume(both, epoch_millis("ts")), lambda s: switch_stream(
        s.withColumn("ts", to_instant("ts")), alerts.SWITCH_MS * 1000), "switch", flush_time="ts")
    return out.select("event_id", "sensor_id", from_epoch_micros("ts_us").alias("ts"), "temp")


@query("temp_jump_ttl_stream", oracle_sql_of("temp_jump_alerts_ttl"))
def temp_jump_ttl_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST20 as a stream: a sensor's last reading is forgotten after an hour, by a timer if it stays silent."""
    rows = _readings(views.sensors(spark, sf_dir))
    out, _ = replay(rows, by_volume(rows, epoch_millis("ts")), lambda s: expiring_jump_stream(
        s.withColumn("ts", to_instant("ts")), alerts.HOUR_MS * 1000, alerts.JUMP), "jump-ttl", flush_time="ts")
    return out.select("sensor_id", "event_id", "temp", "last_temp")


MARK_BATCH_MS, MARK_DELAY_MS = 600_000, 60_000


@query("punctuated_split_stream", with_views("sensors", dense=True) + f"""
, arr AS (SELECT *, epoch_us(ts) // 1000 AS ms, ((epoch_us(ts) // 1000) + (event_id * 7919) % {alerts.MARKED_SHIFT_MS}) // {MARK_BATCH_MS} AS batch FROM sensors),
top AS (SELECT batch, max(CASE WHEN sensor_id = 1 THEN ms END) AS top FROM arr GROUP BY batch),
wm AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {MARK_DELAY_MS} AS wm_ms FROM top)
SELECT event_id, sensor_id, ts, coalesce(ms < wm_ms, FALSE) AS late FROM arr JOIN wm USING (batch)""")
def punctuated_split_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3 as a stream: only marker rows (sensor 1) move the watermark.  The engine has
    no hook for that, so the batch writer keeps the markers' time per batch in the
    shared folder; both outputs are named by the batch, so a replayed one changes
    nothing.  A batch is ten minutes of arrivals."""
    s = disordered_arrival(views.sensors(spark, sf_dir, dense=True), max_shift_ms=alerts.MARKED_SHIFT_MS)
    on_time, late, marks = (scratch_path(spark, f"punctuated-{n}") for n in ("main", "late", "marks"))
    replay(s, F.floor(F.col("arrival_ms") / MARK_BATCH_MS), lambda rows: rows.filter(~F.col(FLUSH)), "punctuated",
           foreach=late_split_writer(on_time, late, marks, "ts", MARK_DELAY_MS, marker=F.col("sensor_id") == 1))
    sides = [spark.read.schema(s.schema).parquet(p).withColumn("late", F.lit(b)) for p, b in ((on_time, False), (late, True))]
    return sides[0].unionByName(sides[1]).select("event_id", "sensor_id", "ts", "late")


RULE_LAG_HOURS = 48


@query("hourly_tips_slow_rules", with_views("fares", "thresholds") + f"""
SELECT 'fare' AS kind, time_bucket(INTERVAL '1 hour', start_time) AS at, driver_id AS id, round(sum(tip), 6) AS value
FROM fares GROUP BY ALL
UNION ALL SELECT 'rule', set_at - INTERVAL '{RULE_LAG_HOURS} hours', id, threshold FROM thresholds""")
def hourly_tips_slow_rules(spark: SparkSession, sf_dir: str, policy: str = "max") -> DataFrame:
    """ST4: fares in hourly windows beside a rule stream that runs two days behind.  With
    the watermark policy ``max`` the fares' clock closes the windows; with ``min`` the
    rules hold back every window of the last two days."""
    fares = views.fares(spark, sf_dir).select(F.lit("fare").alias("kind"), F.col("start_time").alias("at"),
                                              F.col("driver_id").alias("id"), F.col("tip").alias("value"))
    rules_ = views.thresholds(spark, sf_dir).select(
        F.lit("rule").alias("kind"), F.timestamp_add("HOUR", F.lit(-RULE_LAG_HOURS), F.col("set_at")).alias("at"), "id",
        F.col("threshold").cast("double").alias("value"))
    rows = fares.withColumn("sent", F.col("at")).unionByName(
        rules_.withColumn("sent", F.timestamp_add("HOUR", F.lit(RULE_LAG_HOURS), F.col("at"))))

    def build(s: DataFrame) -> DataFrame:
        s = s.withColumn("at", to_instant("at"))
        # the last row, which has no kind, moves the fares' clock only
        of_fares = s.filter(~F.col("kind").eqNullSafe("rule")).withWatermark("at", "1 minute")
        hourly = of_fares.groupBy(F.window("at", "1 hour"), "id", FLUSH).agg(F.sum("value").alias("value"))
        hourly = hourly.select(F.lit("fare").alias("kind"), F.col("window.start").alias("at"), "id", "value", FLUSH)
        return hourly.unionByName(s.filter("kind = 'rule'").withWatermark("at", "1 minute").select("kind", "at", "id", "value", FLUSH))

    conf = "spark.sql.streaming.multipleWatermarkPolicy"
    before = spark.conf.get(conf)
    spark.conf.set(conf, policy)
    try:
        out, _ = replay(rows, by_volume(rows, epoch_millis("sent")), build, "slow-rules", flush_time="at", idle_batches=False)
    finally:
        spark.conf.set(conf, before)
    return out.select("kind", to_wall_clock("at").alias("at"), "id", F.round("value", 6).alias("value"))
