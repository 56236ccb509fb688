"""The derived views written as DuckDB SQL (the independent oracle side).

Each registered query's oracle SQL is prefixed with the CTEs it needs via
``with_views``.  Definitions are fixed by FIXTURES.md.
"""

from __future__ import annotations

_RIDE_GEO = """
 -74.04e0 + 0.02e0 * ((event_id * 7) % 20) AS start_lon, 40.51e0 + 0.04e0 * ((event_id * 11) % 14) AS start_lat,
 -74.04e0 + 0.02e0 * ((event_id * 3) % 20) AS end_lon, 40.51e0 + 0.04e0 * ((event_id * 5) % 14) AS end_lat"""

VIEWS: dict[str, str] = {
    "rides": f"""
SELECT event_id AS ride_id, TRUE AS is_start, ts AS event_time, ts AS start_time, CAST(NULL AS TIMESTAMP) AS end_time,{_RIDE_GEO},
 event_id % 6 + 1 AS passenger_cnt, user_id AS taxi_id, user_id % 40 AS driver_id FROM events WHERE event_id % 41 <> 0
UNION ALL
SELECT event_id, FALSE, ts + CAST(round(value * 180) AS INT) * INTERVAL '1' SECOND, ts,
 ts + CAST(round(value * 180) AS INT) * INTERVAL '1' SECOND,{_RIDE_GEO},
 event_id % 6 + 1, user_id, user_id % 40 FROM events WHERE event_id % 50 <> 0""",
    "fares": """
SELECT event_id AS ride_id, user_id AS taxi_id, user_id % 40 AS driver_id, ts AS start_time,
 CASE WHEN event_id % 2 = 0 THEN 'CSH' ELSE 'CRD' END AS payment_type, value / 10 AS tip, 0e0 AS tolls, value AS total_fare
 FROM events WHERE event_id % 37 <> 0""",
    "cars": """
SELECT event_id AS id, user_id AS car_id, ts AS event_time,
 CASE WHEN event_type IN ('error','signup') THEN 0e0 ELSE value END AS speed, event_id % 20 AS throttle FROM events""",
    "beats": """
SELECT user_id AS instance_id, event_type AS product_id, user_id % 10 AS customer_id, event_id,
 make_timestamp(epoch_us(ts) // 500 + (event_id * 7919) % 600000 * 1000) AS ts FROM events""",
    "sensors": """
SELECT event_id, user_id AS sensor_id, ts, value AS temp FROM events""",
    "mails": """
SELECT concat(conv_id, '-', turn) AS message_id,
 TIMESTAMP '2024-01-01 00:00:00' + conv_id * INTERVAL '1' HOUR + turn * INTERVAL '1' MINUTE AS sent,
 concat(role, ' <', role, conv_id % 25, '@example.org>') AS sender,
 CASE WHEN turn = 0 THEN 'null' ELSE concat(conv_id, '-', turn - 1) END AS reply_to, text AS body FROM conversations""",
    "edges": """
SELECT sn.n_name AS src, cn.n_name AS dst, sum(l_extendedprice * (1 - l_discount)) AS w FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey GROUP BY sn.n_name, cn.n_name""",
    "clicks": """
SELECT event_id, ts, user_id % 20 AS client_id, event_id % 4 AS publisher_id, event_id % 5 AS offer_id,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 7 END AS campaign_id FROM events""",
    "alert_rules": """
SELECT event_id AS alert_use_id, user_id % 20 AS client_id, event_id % 3 + 1 AS entity_type_id, event_id % 4 AS entity_id,
 ts AS begin_ts, ts + 6 * INTERVAL '1' HOUR AS end_ts FROM events WHERE event_type = 'signup' AND event_id % 10 = 0""",
    "thresholds": """
SELECT user_id AS id, event_id AS rule_id, 0.5e0 + (event_id % 5) AS threshold, ts AS set_at FROM events
 WHERE event_type = 'view' AND user_id % 3 = 0""",
}


#: Half a second of the tables is a millisecond (``views.DENSE``).
DENSE_EVENTS = "dense_events AS (SELECT * REPLACE (make_timestamp(epoch_us(ts) // 500) AS ts) FROM events)"


def with_views(*names: str, extra: dict[str, str] | None = None, dense: bool = False) -> str:
    """``WITH v1 AS (...), v2 AS (...)`` for the named views, plus extra CTEs in order;
    ``dense``: the views over ``dense_events``."""
    parts = [f"{n} AS ({VIEWS[n]}\n)" for n in names]
    if dense:
        parts = [DENSE_EVENTS, *(p.replace("FROM events", "FROM dense_events") for p in parts)]
    for k, v in (extra or {}).items():
        parts.append(f"{k} AS ({v}\n)")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""
