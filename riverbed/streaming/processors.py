"""Custom stateful operators for Structured Streaming.

Processors that replay a key's rows in order hold that key's rows of one
micro-batch in memory; the trigger's size limit (files or offsets per
trigger) bounds that, not the key's total volume, which stays in the state
store.

``long_rides_stream``: per ride id, a START waits for its END; an event-time
timeout at start + 2 h emits the START if no END came in time (an END may
arrive first).  Ride ids are dealt to buckets (see ``keyed_state``): a bucket's
state is a row of its unresolved rides, a ride is removed as soon as it is
resolved, and the watermark bounds how long unresolved state lives.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from riverbed.streaming.keyed_state import bucket_of, keys_back

TWO_HOURS_MS = 2 * 3600 * 1000

FLUSH = "_flush"
STATE_SCHEMA = "key array<string>, start_ms array<long>, end_ms array<long>"


def _long_rides(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    wm, out = state.getCurrentWatermarkMs(), []
    rides = {k: (start, end) for k, start, end in zip(*state.get, strict=True)} if state.exists else {}
    for pdf in () if state.hasTimedOut else pdfs:
        for k, is_start, t in zip(pdf["key"], pdf["is_start"], pdf["event_ms"], strict=True):
            start, end = rides.get(k, (None, None))
            rides[k] = (int(t), end) if is_start else (start, int(t))
    waiting = []
    for k, (start, end) in rides.items():
        if start is not None and end is not None and end - start <= TWO_HOURS_MS:
            continue            # resolved: a short ride
        # a START waits for its END until start + 2 h; an END that came first is kept
        # until its START could no longer count as long
        if (start if start is not None else end) + TWO_HOURS_MS > wm:
            waiting.append((k, start, end))
        elif start is not None:
            out.append((k, *key[1:], start))
    if waiting:
        state.update(tuple(list(c) for c in zip(*waiting, strict=True)))
        state.setTimeoutTimestamp(min(start if start is not None else end for _, start, end in waiting) + TWO_HOURS_MS)
    elif state.exists:
        state.remove()
    if out:
        yield pd.DataFrame(out, columns=["key", *([FLUSH] if len(key) > 1 else []), "start_ms"])


def long_rides_stream(rides: DataFrame, delay: str = "1 minute") -> DataFrame:
    """``rides`` is a stream with instant ``event_time`` (see ``as_event_time``); a
    ``_flush`` column, if there, is part of the key and of the result."""
    # the watermark column must stay in the plan; the logic reads epoch millis
    flush = [FLUSH] if FLUSH in rides.columns else []
    r = rides.withWatermark("event_time", delay).select(
        *bucket_of(["ride_id"]), *flush, "is_start", "event_time", (F.unix_micros("event_time") / 1000).cast("long").alias("event_ms"))
    out = r.groupBy("bucket", *flush).applyInPandasWithState(
        _long_rides, f"key string, {FLUSH} boolean, start_ms long" if flush else "key string, start_ms long", STATE_SCHEMA, "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(*keys_back({"ride_id": "long"}), *flush, "start_ms")


class AsOfJoinProcessor(StatefulProcessor):
    """J6 on a stream (``transformWithStateInPandas``, event-time timers).

    Keyed by customer.  Customer rows go to a list state of (ts, info); a trade
    waits in a pending list with a timer at its own time.  When the watermark
    passes the timer the trade is joined with the newest customer row at or
    before it and emitted; customer rows older than the newest one at or
    before the watermark can no longer be chosen and are pruned, so state per
    key stays bounded by the rows inside the watermark delay.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.customers = handle.getListState("customers", "ts long, info string")
        self.pending = handle.getListState("pending", "trade_id long, ts long")

    def handleInputRows(self, key, rows, timerValues):
        new_c, new_t = [], []
        for pdf in rows:
            for kind, tid, ts, info in zip(pdf["kind"], pdf["trade_id"], pdf["ts_ms"], pdf["info"]):
                if kind == "C":
                    new_c.append((int(ts), info))
                else:
                    new_t.append((int(tid), int(ts)))
        if new_c:
            self.customers.appendList(new_c)
        if new_t:
            self.pending.appendList(new_t)
            for _tid, ts in new_t:
                self.handle.registerTimer(ts)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        cust = sorted(self.customers.get()) if self.customers.exists() else []
        pend = list(self.pending.get()) if self.pending.exists() else []
        due = [p for p in pend if p[1] <= wm]
        if not due:
            return iter([])
        out = []
        for tid, ts in due:
            best = None
            for cts, info in cust:
                if cts <= ts:
                    best = (cts, info)
            out.append((key[0], tid, ts, best[1] if best else None, best[0] if best else None))
        rest = [p for p in pend if p[1] > wm]
        self.pending.clear()
        if rest:
            self.pending.put(rest)
        keep_from = max((i for i, (cts, _) in enumerate(cust) if cts <= wm), default=0)
        self.customers.clear()
        if cust[keep_from:]:
            self.customers.put(cust[keep_from:])
        return iter([pd.DataFrame(out, columns=["customer_id", "trade_id", "trade_ms", "customer_info", "matched_ms"])])

    def close(self) -> None:
        pass


def asof_join_stream(events: DataFrame, delay: str = "1 minute") -> DataFrame:
    """``events``: stream of (customer_id, kind 'T'|'C', trade_id, ts instant, info)."""
    _with_rocksdb(events.sparkSession)
    e = events.withWatermark("ts", delay).select(
        "customer_id", "kind", "trade_id", "ts", (F.unix_micros("ts") / 1000).cast("long").alias("ts_ms"), "info")
    return e.groupBy("customer_id").transformWithStateInPandas(
        statefulProcessor=AsOfJoinProcessor(),
        outputStructType="customer_id long, trade_id long, trade_ms long, customer_info string, matched_ms long",
        outputMode="Append", timeMode="EventTime")


class RangeCountProcessor(StatefulProcessor):
    """W1 on a stream: ``COUNT(*) OVER (PARTITION BY key ORDER BY t RANGE
    BETWEEN <range> PRECEDING AND CURRENT ROW)``, which Spark refuses on
    streaming input.  A row is answered once the watermark passes its time
    (every row it can count has arrived); state keeps only the rows inside
    the range behind the watermark plus rows not yet answered."""

    def __init__(self, range_ms: int):
        self.range_ms = range_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "id long, ts long, done boolean")

    def handleInputRows(self, key, rows, timerValues):
        new = []
        for pdf in rows:
            new += [(int(i), int(t), False) for i, t in zip(pdf["id"], pdf["ts_ms"])]
        if new:
            self.rows.appendList(new)
            for ts in {t for _, t, _ in new}:
                self.handle.registerTimer(ts)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        wm = timerValues.getCurrentWatermarkInMs()
        rows = list(self.rows.get()) if self.rows.exists() else []
        ts_sorted = sorted(t for _, t, _ in rows)

        out, keep = [], []
        for i, t, done in rows:
            if not done and t <= wm:
                n = bisect.bisect_right(ts_sorted, t) - bisect.bisect_left(ts_sorted, t - self.range_ms)
                out.append((key[0], i, t, n))
                done = True
            if not done or t >= wm - self.range_ms:
                keep.append((i, t, done))
        self.rows.clear()
        if keep:
            self.rows.put(keep)
        if not out:
            return iter([])
        return iter([pd.DataFrame(out, columns=["key", "id", "ts_ms", "cnt"])])

    def close(self) -> None:
        pass


def range_count_stream(events: DataFrame, key: str, id_col: str, ts: str, range_ms: int,
                       delay: str = "1 minute") -> DataFrame:
    """``events`` is a stream with an instant ``ts`` column; returns (key, id, ts_ms, cnt)."""
    _with_rocksdb(events.sparkSession)
    e = events.withWatermark(ts, delay).select(
        F.col(key).alias("key"), F.col(id_col).alias("id"), ts, (F.unix_micros(ts) / 1000).cast("long").alias("ts_ms"))
    return e.groupBy("key").transformWithStateInPandas(
        statefulProcessor=RangeCountProcessor(range_ms), outputStructType="key long, id long, ts_ms long, cnt long",
        outputMode="Append", timeMode="EventTime")


class HeartbeatSessionProcessor(StatefulProcessor):
    """ST14 per (instance, product, customer): the newest accepted heartbeat time
    in value state; a heartbeat not newer than it is ignored, a newer one emits
    the seconds since the previous one.  Rows of a micro-batch are taken in
    arrival (event id) order."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "ts_s long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows)).sort_values("event_id")
        last = self.last.get()[0] if self.last.exists() else None
        out = []
        for eid, ts in zip(batch["event_id"], batch["ts_s"]):
            ts = int(ts)
            if last is None:
                last = ts
            elif ts > last:
                out.append((*key, int(eid), ts, ts - last))
                last = ts
        self.last.update((last,))
        if out:
            yield pd.DataFrame(out, columns=["instance_id", "product_id", "customer_id", "event_id", "ts_s", "session_s"])

    def close(self) -> None:
        pass


class TravelTimeProcessor(StatefulProcessor):
    """ST25 per (destination cell, direction bucket): running Σxy, Σx², n of
    finished rides in value state; each START is answered with the model as it
    stands (−1 below two points or without a slope).  Rows of a micro-batch are replayed in event
    order, START before END at equal times."""

    def init(self, handle) -> None:
        self.model = handle.getValueState("model", "sxy double, sxx double, n long")

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat(list(rows)).sort_values(["event_ms", "is_end", "ride_id"])
        sxy, sxx, n = self.model.get() if self.model.exists() else (0.0, 0.0, 0)
        out = []
        for rid, is_end, x, y in zip(batch["ride_id"], batch["is_end"], batch["x"], batch["y"]):
            if is_end:
                sxy, sxx, n = sxy + x * y, sxx + x * x, n + 1
            else:
                pred = -1 if n < 2 or sxx == 0 else int(round(sxy / sxx * x, 6))
                out.append((int(rid), *key, pred))
        self.model.update((float(sxy), float(sxx), int(n)))
        if out:
            yield pd.DataFrame(out, columns=["ride_id", "cell", "bucket", "predicted"])

    def close(self) -> None:
        pass


def _with_rocksdb(spark) -> None:
    from riverbed.session import ROCKSDB_PROVIDER
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def heartbeat_sessions_stream(beats: DataFrame) -> DataFrame:
    """``beats``: stream of (instance_id, product_id, customer_id, event_id, ts_s)."""
    _with_rocksdb(beats.sparkSession)
    return beats.groupBy("instance_id", "product_id", "customer_id").transformWithStateInPandas(
        statefulProcessor=HeartbeatSessionProcessor(),
        outputStructType="instance_id long, product_id string, customer_id long, event_id long, ts_s long, "
                         "session_s long", outputMode="Append", timeMode="None")


def travel_time_stream(rides: DataFrame) -> DataFrame:
    """``rides``: stream of (ride_id, is_end, event_ms, cell, bucket, x, y)."""
    _with_rocksdb(rides.sparkSession)
    return rides.groupBy("cell", "bucket").transformWithStateInPandas(
        statefulProcessor=TravelTimeProcessor(),
        outputStructType="ride_id long, cell int, bucket int, predicted int", outputMode="Append", timeMode="None")
