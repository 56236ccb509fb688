"""Rule-driven matching: active alert rules over clicks (J14, ST12), buffered
rule pairs (J11), and early-firing window counts (ST13)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros
from riverbed.operators.joins import asof_join
from riverbed.operators.running import volume_cut
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.sources import views
from riverbed.sources.tables import table

MATCH_SQL = with_views("clicks", "alert_rules").replace("WITH ", "WITH RECURSIVE ", 1) + """
, first_rule AS (
  SELECT client_id, entity_type_id, entity_id, begin_ts, min(alert_use_id) AS alert_use_id,
         arg_min(end_ts, alert_use_id) AS end_ts FROM alert_rules GROUP BY ALL),
linked AS (
  SELECT r.*, n.alert_use_id AS next_id FROM first_rule r ASOF LEFT JOIN first_rule n
    ON n.client_id = r.client_id AND n.entity_type_id = r.entity_type_id AND n.entity_id = r.entity_id
    AND r.end_ts <= n.begin_ts),
held AS (
  SELECT l.* FROM linked l JOIN (
    SELECT client_id, entity_type_id, entity_id, min(begin_ts) AS begin_ts FROM first_rule GROUP BY ALL)
    USING (client_id, entity_type_id, entity_id, begin_ts)
  UNION ALL
  SELECT l.* FROM held h JOIN linked l ON l.alert_use_id = h.next_id),
u AS (SELECT event_id, ts, client_id, 1 AS entity_type_id, publisher_id AS entity_id FROM clicks
      UNION ALL SELECT event_id, ts, client_id, 2, offer_id FROM clicks
      UNION ALL SELECT event_id, ts, client_id, 3, coalesce(campaign_id, 0) FROM clicks),
m AS (SELECT u.event_id, u.entity_type_id, u.ts, u.client_id, r.alert_use_id, r.begin_ts, r.end_ts
      FROM u JOIN held r ON r.client_id = u.client_id AND r.entity_type_id = u.entity_type_id
        AND r.entity_id = u.entity_id AND r.begin_ts <= u.ts AND u.ts < r.end_ts)
"""

RULE_KEY = ["client_id", "entity_type_id", "entity_id"]


def held_rules(rules: DataFrame) -> DataFrame:
    """The rules a key really holds: a rule arriving (at its begin) while the key
    still holds one is dropped for good; a rule that begins when the held one
    ends is taken.  Of rules arriving together the least id is first.

    Which rule is dropped depends on the one held before it, so a key's rules
    are read in order, as a stream of sorted Arrow batches with the end of the
    held rule as the only state.  Rules without a begin or an end are left out.
    """
    known = rules.filter(F.col("begin_ts").isNotNull() & F.col("end_ts").isNotNull())
    ordered = known.repartition(*RULE_KEY).sortWithinPartitions(*RULE_KEY, "begin_ts", "alert_use_id")
    return ordered.mapInPandas(_held_batches, known.schema)


def _held_batches(batches):
    key, until = None, None
    for b in batches:
        keep = []
        for *k, begin, end in b[[*RULE_KEY, "begin_ts", "end_ts"]].astype(object).where(
                b[[*RULE_KEY, "begin_ts", "end_ts"]].notna(), None).itertuples(index=False, name=None):
            taken = k != key or begin >= until
            if taken:
                key, until = k, end
            keep.append(taken)
        yield b[keep]


def entity_clicks(clicks: DataFrame) -> DataFrame:
    """Each click as three rows, one per entity type, with a null entity id as 0."""
    return clicks.select("event_id", "ts", "client_id", F.expr(
        "stack(3, 1, coalesce(publisher_id, 0), 2, coalesce(offer_id, 0), 3, coalesce(campaign_id, 0))"
        " AS (entity_type_id, entity_id)"))


def active_matches(clicks: DataFrame, rules: DataFrame) -> DataFrame:
    """Each click fans out to its three (entity type, id) pairs (null id → 0) and
    meets the rule its key holds at that time: an as-of join with the held
    rules, which don't overlap, then the rule's end checked."""
    u = entity_clicks(clicks)
    r = held_rules(rules.withColumn("entity_type_id", F.col("entity_type_id").cast("int")))
    times = clicks.select("ts").union(rules.select("begin_ts"))
    cut = volume_cut(times, epoch_micros("ts"))
    j = asof_join(u, r, RULE_KEY, "ts", "begin_ts", ["alert_use_id", "end_ts"], chunk_fn=lambda t: cut(epoch_micros(t)), how="inner")
    return j.filter(F.col("ts") < F.col("end_ts")).select(
        "event_id", "entity_type_id", "ts", "client_id", "alert_use_id",
        F.col("matched_at").alias("begin_ts"), "end_ts")


@query("active_alert_filter", MATCH_SQL + "SELECT * EXCLUDE (begin_ts, end_ts) FROM m")
def active_alert_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_matches(views.clicks(spark, sf_dir), views.alert_rules(spark, sf_dir)).drop("begin_ts", "end_ts")


@query("alert_interval_counts", MATCH_SQL + """
SELECT client_id, date_trunc('second', begin_ts) AS window_begin, date_trunc('second', end_ts) AS window_end,
       count(*) AS cnt
FROM m GROUP BY ALL""")
def alert_interval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched clicks counted per client in the rule's own window [begin, end) cut
    to whole seconds (ST12)."""
    m = active_matches(views.clicks(spark, sf_dir), views.alert_rules(spark, sf_dir))
    # date_trunc yields a session-zone TIMESTAMP; keep the UTC wall clock type
    sec = lambda c: F.date_trunc("second", c).cast("timestamp_ntz")
    return m.groupBy("client_id", sec("begin_ts").alias("window_begin"),
                     sec("end_ts").alias("window_end")).agg(F.count(F.lit(1)).alias("cnt"))


# fixed values: (first shape, second shape) rule pairs over the event kinds
RULE_PAIRS = {1: ("view", "purchase"), 2: ("click", "purchase"), 3: ("signup", "error")}


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("event_type").alias("shape"), (F.col("user_id") % 5).alias("color"))


@query("rule_pair_match", """
WITH items AS (SELECT event_id, event_type AS shape, user_id % 5 AS color FROM events),
rules(rule_id, first_shape, second_shape) AS (VALUES """
       + ", ".join(f"({k}, '{a}', '{b}')" for k, (a, b) in RULE_PAIRS.items()) + """),
f AS (SELECT r.rule_id, i.color, i.event_id FROM items i JOIN rules r ON i.shape = r.first_shape),
s AS (SELECT r.rule_id, i.color, i.event_id FROM items i JOIN rules r ON i.shape = r.second_shape)
SELECT f.rule_id, f.color, f.event_id AS first_event_id, s.event_id AS second_event_id
FROM f ASOF JOIN s ON f.rule_id = s.rule_id AND f.color = s.color AND f.event_id < s.event_id""")
def rule_pair_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per color and rule, every buffered first-shape item is paired with the next
    second-shape item (which flushes the buffer): a forward as-of join on
    arrival order, keyed by (color, rule) (J11)."""
    it = _items(spark, sf_dir)
    first_of = F.array(*[F.when(F.col("shape") == a, F.lit(k)) for k, (a, _) in RULE_PAIRS.items()])
    second_of = F.array(*[F.when(F.col("shape") == b, F.lit(k)) for k, (_, b) in RULE_PAIRS.items()])
    f = it.select("color", "event_id", F.explode(F.filter(first_of, lambda x: x.isNotNull())).alias("rule_id"))
    s = it.select("color", "event_id", F.explode(F.filter(second_of, lambda x: x.isNotNull())).alias("rule_id"))
    f = f.select("rule_id", "color", F.col("event_id").alias("first_event_id"), (-F.col("event_id")).alias("neg_f"))
    s = s.select("rule_id", "color", F.col("event_id").alias("second_event_id"), (-F.col("event_id")).alias("neg_s"))
    j = asof_join(f, s, ["rule_id", "color"], "neg_f", "neg_s", ["second_event_id"], how="inner")
    return j.select("rule_id", "color", "first_event_id", "second_event_id")


FIRE_WINDOW_S = 10


@query("early_fire_counts", with_views("sensors") + f"""
, t AS (SELECT sensor_id, time_bucket(INTERVAL '{FIRE_WINDOW_S} seconds', ts) + INTERVAL '{FIRE_WINDOW_S} seconds' AS window_end,
               unnest(generate_series(date_trunc('second', ts) + INTERVAL '1 second',
                      time_bucket(INTERVAL '{FIRE_WINDOW_S} seconds', ts) + INTERVAL '{FIRE_WINDOW_S} seconds',
                      INTERVAL '1 second')) AS tick FROM sensors)
SELECT sensor_id, window_end, tick, count(*) AS cnt FROM t GROUP BY ALL""")
def early_fire_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window counts fired every second of event time inside a 10 s window and
    at its end (ST13): each reading adds one to every tick after its second,
    so the explode is bounded by the window length."""
    s = views.sensors(spark, sf_dir)
    end = F.window("ts", f"{FIRE_WINDOW_S} seconds").end
    s = s.select("sensor_id", end.alias("window_end"),
                 F.timestamp_add("SECOND", F.lit(1), F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("first_tick"))
    ticks = s.select("sensor_id", "window_end", F.explode(
        F.sequence("first_tick", "window_end", F.expr("INTERVAL 1 SECOND"))).alias("tick"))
    return ticks.groupBy("sensor_id", "window_end", "tick").agg(F.count(F.lit(1)).alias("cnt"))
