"""Sensor alerts, late data and enrichment joins over ``events`` read as readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros, epoch_millis, from_epoch_millis
from riverbed.operators.joins import asof_join, band_join
from riverbed.operators.late import disordered_arrival, is_late, with_watermark_seen
from riverbed.operators.running import join_back, previous_value, running_sum, volume_chunk, volume_cut
from riverbed.operators.windows import tumbling_agg
from riverbed.plans.oracle_views import DENSE_EVENTS, with_views
from riverbed.plans.registry import query
from riverbed.sources import views
from riverbed.sources.tables import table

SV = with_views("sensors")
JUMP = 1.7            # ratio threshold of the keyed-state alert example
DEFAULT_THRESHOLD = 4.0
HOUR_MS = 3600 * 1000


def with_last_temp(s: DataFrame) -> DataFrame:
    """Previous reading of the same sensor in arrival order (value state)."""
    prev = F.struct(F.col("temp").alias("t"), F.col("ts").alias("at"))
    d = previous_value(s, ["sensor_id"], ["event_id"], volume_chunk(s, F.col("event_id")), prev, "_prev")
    return d.withColumn("last_temp", F.col("_prev.t")).withColumn("last_ts", F.col("_prev.at")).drop("_prev")


@query("temp_jump_alerts", SV + f"""
SELECT sensor_id, event_id, temp, last_temp FROM (
  SELECT *, lag(temp) OVER (PARTITION BY sensor_id ORDER BY event_id) AS last_temp FROM sensors)
WHERE last_temp > 0 AND temp / last_temp > {JUMP}e0""")
def temp_jump_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert when a reading exceeds the sensor's previous one by a ratio > 1.7."""
    d = with_last_temp(views.sensors(spark, sf_dir))
    return d.filter((F.col("last_temp") > 0) & (F.col("temp") / F.col("last_temp") > JUMP)).select(
        "sensor_id", "event_id", "temp", "last_temp")


@query("temp_jump_alerts_ttl", SV + f"""
SELECT sensor_id, event_id, temp, last_temp FROM (
  SELECT *, lag(temp) OVER w AS last_temp, lag(ts) OVER w AS last_ts FROM sensors
  WINDOW w AS (PARTITION BY sensor_id ORDER BY event_id))
WHERE last_temp > 0 AND temp / last_temp > {JUMP}e0 AND ts - last_ts < INTERVAL '1 hour'""")
def temp_jump_alerts_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As W2, but a sensor forgets its last reading one hour after it (ST20)."""
    d = with_last_temp(views.sensors(spark, sf_dir))
    fresh = F.timestamp_diff("MILLISECOND", F.col("last_ts"), F.col("ts")) < HOUR_MS
    return d.filter((F.col("last_temp") > 0) & (F.col("temp") / F.col("last_temp") > JUMP) & fresh).select(
        "sensor_id", "event_id", "temp", "last_temp")


@query("dynamic_threshold_alerts", with_views("sensors", "thresholds") + f"""
, rule AS (SELECT id, set_at, arg_max(threshold, rule_id) AS threshold FROM thresholds GROUP BY ALL)
SELECT s.sensor_id, s.event_id, s.temp, s.last_temp FROM (
  SELECT *, lag(temp) OVER (PARTITION BY sensor_id ORDER BY event_id) AS last_temp FROM sensors) s
ASOF LEFT JOIN rule t ON t.id = s.sensor_id AND s.ts >= t.set_at
WHERE s.last_temp > 0
  AND s.temp / s.last_temp > CASE WHEN t.threshold >= 1e0 THEN t.threshold ELSE {DEFAULT_THRESHOLD}e0 END""")
def dynamic_threshold_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_alerts(with_last_temp(views.sensors(spark, sf_dir)), views.thresholds(spark, sf_dir))


def threshold_alerts(readings: DataFrame, rules: DataFrame) -> DataFrame:
    """Ratio alert whose threshold comes from a stream of rule updates (J9): each
    reading meets the newest update of its sensor; an update below 1.0 removes
    the rule, and without a rule the default 4.0 holds.  An as-of join on the
    rule history, so earlier readings keep the rule of their own time."""
    r = rules.select(F.col("id").alias("sensor_id"), "rule_id", "threshold", "set_at")
    j = asof_join(readings, r, ["sensor_id"], "ts", "set_at", ["rule_id", "threshold"])
    thr = F.when(F.col("threshold") >= 1.0, F.col("threshold")).otherwise(F.lit(DEFAULT_THRESHOLD))
    return j.filter((F.col("last_temp") > 0) & (F.col("temp") / F.col("last_temp") > thr)).select(
        "sensor_id", "event_id", "temp", "last_temp")


def smoke_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoke-level stream: every error event sets the level, HIGH above 50."""
    ev = table(spark, sf_dir, "events")
    return ev.filter(F.col("event_type") == "error").select(
        F.col("ts").alias("smoke_ts"), F.when(F.col("value") > 50, "HIGH").otherwise("LOW").alias("smoke"))


@query("fire_risk_alerts", with_views("sensors", extra={"smoke": """
SELECT ts AS smoke_ts, CASE WHEN value > 50 THEN 'HIGH' ELSE 'LOW' END AS smoke FROM events WHERE event_type = 'error'"""})
       + """
SELECT r.event_id, r.sensor_id, r.temp, s.smoke_ts AS smoke_at
FROM sensors r ASOF JOIN smoke s ON r.ts >= s.smoke_ts
WHERE r.temp > 100e0 AND s.smoke = 'HIGH'""")
def fire_risk_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hot reading while the latest smoke level is HIGH (J10): an as-of join
    with no key, chunked by volume so it is not a single-partition window."""
    hot = views.sensors(spark, sf_dir).filter(F.col("temp") > 100.0).select("event_id", "sensor_id", "ts", "temp")
    j = asof_join(hot, smoke_levels(spark, sf_dir), [], "ts", "smoke_ts", ["smoke"], how="inner")
    return j.filter(F.col("smoke") == "HIGH").select("event_id", "sensor_id", "temp", F.col("matched_at").alias("smoke_at"))


@query("rising_run_alerts", SV + """
, flagged AS (
  SELECT *, coalesce(temp < last_temp, FALSE) AS is_dec, coalesce(temp > last_temp, FALSE) AS is_rise FROM (
    SELECT *, lag(temp) OVER (PARTITION BY sensor_id ORDER BY ts, event_id) AS last_temp FROM sensors)),
seg AS (
  SELECT *, sum(CASE WHEN is_dec THEN 1 ELSE 0 END) OVER (PARTITION BY sensor_id ORDER BY ts, event_id
                                                          ROWS UNBOUNDED PRECEDING) AS seg FROM flagged),
segs AS (
  SELECT sensor_id, seg, min(ts) AS seg_start, min(CASE WHEN is_rise THEN ts END) AS rise_ts FROM seg GROUP BY ALL)
SELECT a.sensor_id, a.rise_ts, a.rise_ts + INTERVAL '1 second' AS alert_ts
FROM segs a LEFT JOIN segs b ON a.sensor_id = b.sensor_id AND b.seg = a.seg + 1
WHERE a.rise_ts IS NOT NULL AND (b.seg_start IS NULL OR a.rise_ts + INTERVAL '1 second' < b.seg_start)""")
def rising_run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperature rose and did not fall for 1 s of event time (ST19, re-aimed
    from processing time).  Falls cut a sensor's readings into segments; a
    segment's first rise arms a 1 s timer that the next fall cancels."""
    return rising_runs(views.sensors(spark, sf_dir).select("event_id", "sensor_id", "ts", "temp"))


def rising_runs(s: DataFrame) -> DataFrame:
    """``rising_run_alerts`` of any readings; a null sensor is a sensor."""
    chunk = volume_chunk(s, epoch_micros("ts"))
    d = previous_value(s, ["sensor_id"], ["ts", "event_id"], chunk, F.col("temp"), "last_temp")
    d = d.withColumn("is_dec", F.coalesce(F.col("temp") < F.col("last_temp"), F.lit(False))) \
         .withColumn("is_rise", F.coalesce(F.col("temp") > F.col("last_temp"), F.lit(False)))
    d = running_sum(d, ["sensor_id"], ["ts", "event_id"], chunk,
                    F.col("is_dec").cast("bigint"), "seg")
    segs = d.groupBy("sensor_id", "seg").agg(F.min("ts").alias("seg_start"),
                                             F.min(F.when(F.col("is_rise"), F.col("ts"))).alias("rise_ts"))
    nxt = segs.select(F.col("sensor_id").alias("next_id"), (F.col("seg") - 1).alias("next_seg"), F.col("seg_start").alias("next_start"))
    j = segs.filter(F.col("rise_ts").isNotNull()).join(
        nxt, F.col("sensor_id").eqNullSafe(F.col("next_id")) & (F.col("seg") == F.col("next_seg")), "left")
    alert = F.timestamp_add("SECOND", F.lit(1), F.col("rise_ts"))
    return j.filter(F.col("next_start").isNull() | (alert < F.col("next_start"))).select(
        "sensor_id", "rise_ts", alert.alias("alert_ts"))


@query("freezing_side_output", SV + """
SELECT event_id, sensor_id, temp, 'Freezing Alarm for ' || sensor_id AS alarm FROM sensors WHERE temp < 32e0""")
def freezing_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Side output of readings below 32 °F; the main output is every reading (ST22)."""
    s = views.sensors(spark, sf_dir)
    return s.filter(F.col("temp") < 32.0).select(
        "event_id", "sensor_id", "temp", F.concat(F.lit("Freezing Alarm for "), F.col("sensor_id").cast("string")).alias("alarm"))


DISORDER_MS, SHIFT_MS, MARKED_SHIFT_MS = 5000, 20_000, 120_000
DV = with_views("sensors", dense=True)
ARRIVAL_SQL = """
, arr AS (SELECT *, (epoch_us(ts) // 1000) + (event_id * 7919) % 20000 AS arrival_ms FROM sensors),
wm AS (SELECT *, max((epoch_us(ts) // 1000)) OVER (ORDER BY arrival_ms, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {delay} AS wm_ms FROM arr)"""


def _arrivals(spark: SparkSession, sf_dir: str, delay_ms: int = DISORDER_MS, marker=None, shift_ms: int = SHIFT_MS) -> DataFrame:
    s = disordered_arrival(views.sensors(spark, sf_dir, dense=True), max_shift_ms=shift_ms)
    return with_watermark_seen(s, delay_ms, marker=marker)


@query("late_side_output", DV + ARRIVAL_SQL.format(delay=DISORDER_MS) + """
SELECT event_id, sensor_id, ts, wm_ms FROM wm WHERE (epoch_us(ts) // 1000) < wm_ms""")
def late_side_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows behind the watermark at their arrival, routed to a side output (ST8)."""
    a = _arrivals(spark, sf_dir)
    return a.filter(is_late()).select("event_id", "sensor_id", "ts", "wm_ms")


@query("punctuated_late_split", DV + """
, arr AS (SELECT *, (epoch_us(ts) // 1000) + (event_id * 7919) % 120000 AS arrival_ms FROM sensors),
wm AS (SELECT *, max(CASE WHEN sensor_id = 1 THEN (epoch_us(ts) // 1000) END) OVER (ORDER BY arrival_ms, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 60000 AS wm_ms FROM arr)
SELECT event_id, sensor_id, ts, coalesce((epoch_us(ts) // 1000) < wm_ms, FALSE) AS late FROM wm""")
def punctuated_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Watermark advanced only by marker rows (sensor 1), 60 s behind them; every
    row is tagged late or on time (ST3)."""
    a = _arrivals(spark, sf_dir, 60000, marker=F.col("sensor_id") == 1, shift_ms=MARKED_SHIFT_MS)
    return a.select("event_id", "sensor_id", "ts", is_late().alias("late"))


WIN_MS = 10000
LATENESS_MS = 5000


def _windowed_arrivals(spark, sf_dir):
    a = _arrivals(spark, sf_dir)
    end_ms = (F.floor(epoch_millis("ts") / WIN_MS) + 1) * WIN_MS
    return a.withColumn("window_end_ms", end_ms).withColumn("window_end", from_epoch_millis(end_ms))


@query("late_window_counts", DV + ARRIVAL_SQL.format(delay=DISORDER_MS) + f"""
SELECT sensor_id, time_bucket(INTERVAL '10 seconds', ts) + INTERVAL '10 seconds' AS window_end,
  CAST(sum(CASE WHEN coalesce(wm_ms >= epoch_ms(time_bucket(INTERVAL '10 seconds', ts)) + {WIN_MS}, FALSE) THEN 0 ELSE 1 END) AS BIGINT) AS cnt,
  CAST(sum(CASE WHEN coalesce(wm_ms >= epoch_ms(time_bucket(INTERVAL '10 seconds', ts)) + {WIN_MS}, FALSE) THEN 1 ELSE 0 END) AS BIGINT) AS late_cnt
FROM wm GROUP BY ALL""")
def late_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10 s counts per sensor; rows whose window had closed when they arrived are
    counted apart as late (ST8, per window)."""
    a = _windowed_arrivals(spark, sf_dir)
    late = F.coalesce(F.col("wm_ms") >= F.col("window_end_ms"), F.lit(False))
    return a.groupBy("sensor_id", "window_end").agg(
        F.sum(F.when(late, 0).otherwise(1)).cast("bigint").alias("cnt"),
        F.sum(F.when(late, 1).otherwise(0)).cast("bigint").alias("late_cnt"))


@query("late_updates", DV + ARRIVAL_SQL.format(delay=DISORDER_MS) + f"""
, tagged AS (
  SELECT *, epoch_ms(time_bucket(INTERVAL '10 seconds', ts)) + {WIN_MS} AS end_ms,
         coalesce(wm_ms >= epoch_ms(time_bucket(INTERVAL '10 seconds', ts)) + {WIN_MS}, FALSE) AS late FROM wm),
fires AS (
  SELECT sensor_id, end_ms, 0 AS k, count(*) AS cnt FROM tagged WHERE NOT late GROUP BY ALL
  UNION ALL
  SELECT sensor_id, end_ms, row_number() OVER (PARTITION BY sensor_id, end_ms ORDER BY arrival_ms, event_id) AS k,
         (SELECT count(*) FROM tagged t2 WHERE NOT t2.late AND t2.sensor_id = t.sensor_id AND t2.end_ms = t.end_ms)
         + row_number() OVER (PARTITION BY sensor_id, end_ms ORDER BY arrival_ms, event_id) AS cnt
  FROM tagged t WHERE late AND wm_ms < end_ms + {LATENESS_MS})
SELECT sensor_id, make_timestamp(end_ms * 1000) AS window_end, CAST(cnt AS BIGINT) AS cnt,
       CASE WHEN row_number() OVER (PARTITION BY sensor_id, end_ms ORDER BY k) = 1 THEN 'first' ELSE 'update' END AS mark
FROM fires""")
def late_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed lateness 5 s (ST9): a window fires once when the watermark passes
    its end, then once more per late row accepted before end + 5 s; the first
    firing is marked "first", later ones "update".  Later rows are dropped."""
    a = _windowed_arrivals(spark, sf_dir)
    late = F.coalesce(F.col("wm_ms") >= F.col("window_end_ms"), F.lit(False))
    a = a.withColumn("late", late)
    keys = ["sensor_id", "window_end_ms"]
    on_time = a.filter(~F.col("late")).groupBy(*keys).agg(F.count(F.lit(1)).alias("base"))
    accepted = a.filter(F.col("late") & (F.col("wm_ms") < F.col("window_end_ms") + LATENESS_MS))
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy("arrival_ms", "event_id")
    upd = accepted.select(*keys, F.row_number().over(w).alias("k")).join(
        on_time.withColumnsRenamed({c: f"_on_{c}" for c in keys}),
        [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in keys], "left").select(
        *keys, "k", (F.coalesce(F.col("base"), F.lit(0)) + F.col("k")).alias("cnt"))
    fires = on_time.select(*keys, F.lit(0).alias("k"), F.col("base").alias("cnt")).unionByName(upd)
    first_k = fires.groupBy(*keys).agg(F.min("k").alias("first_k"))
    return join_back(fires, first_k, keys).select(
        "sensor_id", from_epoch_millis("window_end_ms").alias("window_end"), F.col("cnt").cast("bigint").alias("cnt"),
        F.when(F.col("k") == F.col("first_k"), "first").otherwise("update").alias("mark"))


@query("dedup_by_key", """
SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text""")
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct on one column, keeping the smallest id deterministically.

    Grouped by a SHA-256 of the text, so only 32 bytes per row cross the
    shuffle instead of the whole text; the count is a partial aggregate.
    """
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("h"))
    return d.groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")).drop("h")


def trades_customers(spark: SparkSession, sf_dir: str, dense: bool = False):
    ev = views.events(spark, sf_dir, dense)
    trades = ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("trade_id"), F.col("user_id").alias("customer_id"), F.col("ts").alias("trade_ts"))
    customers = ev.filter(F.col("event_type") == "view").select(
        F.col("user_id").alias("customer_id"), F.col("ts").alias("cust_ts"),
        F.concat(F.lit("info-"), F.col("event_id").cast("string")).alias("customer_info"), "event_id")
    return trades, customers


TC_SQL = """
WITH trades AS (SELECT event_id AS trade_id, user_id AS customer_id, ts AS trade_ts FROM events WHERE event_type = 'purchase'),
customers AS (SELECT user_id AS customer_id, ts AS cust_ts, 'info-' || event_id AS customer_info, event_id
              FROM events WHERE event_type = 'view')
"""

DENSE_TC_SQL = TC_SQL.replace("FROM events", "FROM dense_events").replace("WITH ", f"WITH {DENSE_EVENTS}, ", 1)


@query("asof_enrich", TC_SQL + """
SELECT t.trade_id, t.customer_id, t.trade_ts, c.customer_info, c.cust_ts AS matched_at
FROM trades t ASOF LEFT JOIN customers c ON t.customer_id = c.customer_id AND t.trade_ts >= c.cust_ts""")
def asof_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each trade with the newest customer row at or before its time, null if none."""
    trades, customers = trades_customers(spark, sf_dir)
    return asof_join(trades, customers, ["customer_id"], "trade_ts", "cust_ts", ["customer_info"])


@query("arrival_enrich", TC_SQL + """
SELECT t.trade_id, t.customer_id, t.trade_ts, c.customer_info FROM trades t
ASOF LEFT JOIN customers c ON t.customer_id = c.customer_id AND t.trade_id > c.event_id""")
def arrival_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing-time enrichment (J8): the customer row that arrived last before
    the trade, arrival order being the event id."""
    trades, customers = trades_customers(spark, sf_dir)
    j = asof_join(trades, customers, ["customer_id"], "trade_id", "event_id", ["customer_info"])
    return j.select("trade_id", "customer_id", "trade_ts", "customer_info")


SWITCH_MS = HOUR_MS


@query("switch_forward", SV + """
, switches AS (SELECT user_id AS sensor_id, ts AS switch_ts FROM events WHERE event_type = 'click')
SELECT event_id, sensor_id, ts, temp FROM sensors s WHERE EXISTS (
  SELECT 1 FROM switches w WHERE w.sensor_id = s.sensor_id AND s.ts BETWEEN w.switch_ts AND w.switch_ts + INTERVAL '1 hour')""")
def switch_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings pass for one hour after a switch event of the same sensor (J16): the
    newest switch at or before a reading decides, so an as-of join is enough."""
    s = views.sensors(spark, sf_dir).select("event_id", "sensor_id", "ts", "temp")
    j = asof_join(s, switch_events(spark, sf_dir), ["sensor_id"], "ts", "switch_ts", ["switch_id"], how="inner")
    open_ = F.timestamp_add("MILLISECOND", F.lit(SWITCH_MS), F.col("matched_at"))
    return j.filter(F.col("ts") <= open_).select("event_id", "sensor_id", "ts", "temp")


def switch_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").filter(F.col("event_type") == "click").select(
        F.col("user_id").alias("sensor_id"), F.col("ts").alias("switch_ts"), F.col("event_id").alias("switch_id"))


@query("lookup_enrich", SV + """
SELECT s.event_id, s.sensor_id, s.temp, coalesce(c.c_name, 'UNKNOWN ROOM') AS room
FROM sensors s LEFT JOIN customer c ON c.c_custkey = s.sensor_id * 20""")
def lookup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings enriched with a room from a dimension table; a miss gives
    UNKNOWN ROOM (J15: the async look-up re-aimed as a join)."""
    s = views.sensors(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("room_id"), F.col("c_name").alias("room"))
    # sensors are numbered densely, rooms are every twentieth customer; many sensors have none
    s = s.withColumn("room_id", F.col("sensor_id") * 20)
    return s.join(c, "room_id", "left").select(
        "event_id", "sensor_id", "temp", F.coalesce(F.col("room"), F.lit("UNKNOWN ROOM")).alias("room"))


ASOF_LATE_MS = 5000


@query("asof_enrich_late", DENSE_TC_SQL + f"""
, u AS (SELECT trade_id AS event_id, trade_ts AS ts, TRUE AS is_trade FROM trades
        UNION ALL SELECT event_id, cust_ts, FALSE FROM customers),
arr AS (SELECT *, (epoch_us(ts) // 1000) + (event_id * 7919) % 20000 AS arrival_ms FROM u),
wm AS (SELECT *, max(epoch_us(ts) // 1000) OVER (ORDER BY arrival_ms, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {ASOF_LATE_MS} AS wm_ms FROM arr)
SELECT t.trade_id, t.customer_id, t.trade_ts, c.customer_info, c.cust_ts AS matched_at,
       coalesce(epoch_us(w.ts) // 1000 < w.wm_ms, FALSE) AS late
FROM trades t ASOF LEFT JOIN customers c ON t.customer_id = c.customer_id AND t.trade_ts >= c.cust_ts
JOIN wm w ON w.event_id = t.trade_id AND w.is_trade""")
def asof_enrich_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7, first goal: trades behind the watermark (trades and customer updates
    share one disordered arrival order, 5 s bound) are still enriched with the
    event-time-correct customer instead of being dropped, and flagged late."""
    trades, customers = trades_customers(spark, sf_dir, dense=True)
    u = trades.select(F.col("trade_id").alias("event_id"), F.col("trade_ts").alias("ts"), F.lit(True).alias("is_trade")) \
        .unionByName(customers.select("event_id", F.col("cust_ts").alias("ts"), F.lit(False).alias("is_trade")))
    seen = with_watermark_seen(disordered_arrival(u, max_shift_ms=SHIFT_MS), ASOF_LATE_MS)
    flags = seen.filter("is_trade").select(F.col("event_id").alias("trade_id"), is_late().alias("late"))
    j = asof_join(trades, customers, ["customer_id"], "trade_ts", "cust_ts", ["customer_info"])
    return j.join(flags, "trade_id").select("trade_id", "customer_id", "trade_ts", "customer_info", "matched_at", "late")


REVISE_BOUND_MS = 7000   # arrival lags event time by less than this (the disorder of the input)


@query("asof_enrich_revise", DENSE_TC_SQL + """
, ta AS (SELECT *, (epoch_us(trade_ts) // 1000) + (trade_id * 7919) % 7000 AS arr FROM trades),
ca AS (SELECT *, (epoch_us(cust_ts) // 1000) + (event_id * 7919) % 7000 AS arr FROM customers),
r0 AS (SELECT t.trade_id, arg_max(c.customer_info, (c.cust_ts, c.event_id)) AS info,
              arg_max(c.event_id, (c.cust_ts, c.event_id)) AS cid
       FROM ta t LEFT JOIN ca c ON c.customer_id = t.customer_id AND c.cust_ts <= t.trade_ts
         AND (c.arr < t.arr OR (c.arr = t.arr AND c.event_id < t.trade_id)) GROUP BY t.trade_id),
r1 AS (SELECT t.trade_id, c.customer_info AS info, c.event_id AS cid FROM trades t
       ASOF LEFT JOIN customers c ON t.customer_id = c.customer_id AND t.trade_ts >= c.cust_ts)
SELECT trade_id, 0 AS revision, info AS customer_info FROM r0
UNION ALL
SELECT r1.trade_id, 1, r1.info FROM r1 JOIN r0 USING (trade_id) WHERE r1.cid IS DISTINCT FROM r0.cid""")
def asof_enrich_revise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J7, second goal: emit each trade at its arrival with the newest customer
    row that had arrived by then (revision 0), and a correction (revision 1)
    when the event-time answer turns out different.

    Rows older than the disorder bound have surely arrived, so revision 0 is the
    newer of an as-of match at trade time − 7 s and the newest row inside the
    last 7 s that arrived before the trade (a keyed 7 s band join) — exact
    without comparing every pair of a key."""
    return asof_revise_df(*trades_customers(spark, sf_dir, dense=True))


def asof_revise_df(trades: DataFrame, customers: DataFrame) -> DataFrame:
    """trades(trade_id, customer_id, trade_ts), customers(customer_id, cust_ts,
    customer_info, event_id); arrival = event time + (id·7919 mod 7000) ms."""
    arr = lambda ts, i: epoch_millis(ts) + (F.col(i) * 7919) % 7000
    ta = trades.withColumn("t_arr", arr("trade_ts", "trade_id"))
    ca = customers.withColumn("c_arr", arr("cust_ts", "event_id"))
    key = lambda: F.struct("cust_ts", "event_id")
    cut = volume_cut(trades.select("trade_ts").union(customers.select("cust_ts")), epoch_micros("trade_ts"))
    chunk = lambda t: cut(epoch_micros(t))
    old = asof_join(ta.withColumn("t_old", F.timestamp_add("MILLISECOND", F.lit(-REVISE_BOUND_MS), F.col("trade_ts"))),
                    customers, ["customer_id"], "t_old", "cust_ts", ["customer_info", "event_id"], chunk_fn=chunk)
    old = old.select("trade_id", F.when(F.col("event_id").isNotNull(), F.struct(
        F.col("matched_at").alias("cust_ts"), "event_id", "customer_info")).alias("c_old"))
    band = band_join(ta, ca, ["customer_id"], "trade_ts", "cust_ts", -REVISE_BOUND_MS, 0)
    band = band.filter((F.col("cust_ts") <= F.col("trade_ts")) & (
        (F.col("c_arr") < F.col("t_arr")) | ((F.col("c_arr") == F.col("t_arr")) & (F.col("event_id") < F.col("trade_id")))))
    recent = band.groupBy("trade_id").agg(F.max_by(F.struct("cust_ts", "event_id", "customer_info"), key()).alias("c_new"))
    r0 = old.join(recent, "trade_id", "left").select(
        "trade_id", F.when(F.col("c_new").isNull(), F.col("c_old")).when(F.col("c_old").isNull(), F.col("c_new"))
        .when(F.struct("c_new.cust_ts", "c_new.event_id") > F.struct("c_old.cust_ts", "c_old.event_id"), F.col("c_new"))
        .otherwise(F.col("c_old")).alias("r0"))
    final = asof_join(trades, customers, ["customer_id"], "trade_ts", "cust_ts", ["customer_info", "event_id"], chunk_fn=chunk)
    both = r0.join(final.select("trade_id", F.col("event_id").alias("cid1"), F.col("customer_info").alias("info1")),
                   "trade_id")
    rev0 = both.select("trade_id", F.lit(0).alias("revision"), F.col("r0.customer_info").alias("customer_info"))
    rev1 = both.filter(~F.col("cid1").eqNullSafe(F.col("r0.event_id"))).select(
        "trade_id", F.lit(1).alias("revision"), F.col("info1").alias("customer_info"))
    return rev0.unionByName(rev1)
