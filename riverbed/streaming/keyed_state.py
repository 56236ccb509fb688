"""Stateful processors whose state outlives its window, its rule or its row:
windows with allowed lateness, rules and rows in one keyed state, windows that fire
early.  State lies in Spark's state store and goes with event-time timers.

Keys are dealt to ``BUCKETS`` buckets by their hash, and a bucket is what Spark groups
by: a call of Python, a read and a write of state are for all of a bucket's keys that a
micro-batch touches, not for each key.  A bucket's state is a row of arrays, and its one
timer is that of its earliest deadline.  Keys travel as text, so that null is a key and
long ids stay exact.

The watermark is the engine's: that of the batches before.  Timers it has already
passed count as fired before the batch's rows, although Spark hands over the rows
first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from riverbed.streaming.replay import FLUSH

BUCKETS = 1024


def bucket_of(keys: list[str]) -> list[Column]:
    """The bucket of a row's key and the key, numbers, as text."""
    text = F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return [F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias("bucket"), text.alias("key")]


def keys_back(keys: dict[str, str]) -> list[Column]:
    parts = F.split("key", ",")
    return [F.nullif(parts[i], F.lit("")).cast(t).alias(k) for i, (k, t) in enumerate(keys.items())]


def _buckets(rows: DataFrame, keys: dict[str, str], columns: list, processor: StatefulProcessor, schema: str, time_mode: str = "EventTime") -> DataFrame:
    """Run ``processor`` on the buckets of ``keys``; it gives rows of ``key, _flush`` and ``schema``."""
    r = rows.select(*bucket_of(list(keys)), FLUSH, *columns)
    out = r.groupBy("bucket", FLUSH).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=f"key string, {FLUSH} boolean, {schema}", outputMode="Append", timeMode=time_mode)
    return out.select(*keys_back(keys), *out.columns[1:])


def _sorted_rows(rows: Iterator[pd.DataFrame], order: list[str]) -> Iterator[tuple]:
    """A bucket's rows of one micro-batch in order; the trigger's size bounds them."""
    batch = pd.concat(list(rows)).sort_values(order, kind="stable")
    columns = [batch[c].astype(object).where(batch[c].notna(), None) for c in batch.columns]
    return zip(*columns, strict=True)


def _load(state) -> list[tuple]:
    """The entries of a bucket's state, kept as an array for each field."""
    return list(zip(*state.get(), strict=True)) if state.exists() else []


def _store(state, entries: Iterable[tuple]) -> None:
    columns = tuple(list(c) for c in zip(*entries, strict=True))
    if columns:
        state.update(columns)
    else:
        state.clear()


def _frame(out: list[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    return iter([pd.DataFrame(out, columns=columns)] if out else [])


class LateWindowProcessor(StatefulProcessor):
    """ST9: counts per key and window, kept ``lateness`` ms past the window's end.

    The window fires when the watermark passes its end, and again for each row
    that comes later, up to end + lateness; a fired flag in the state tells the
    first firing from updates.  A row behind that is dropped, and comes out as
    such.  A second timer purges the window.  Each window is a key of its own, and its
    rows of a micro-batch are only counted: its state is read and written once a batch."""

    def __init__(self, lateness_ms: int):
        self.lateness = lateness_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.windows = handle.getValueState("windows", "cnt long, fired boolean")

    def handleInputRows(self, key, rows, timerValues):
        wm, end, sizes = timerValues.getCurrentWatermarkInMs(), key[2], (len(b) for b in rows)
        if end + self.lateness <= wm:
            for n in sizes:
                yield _late(key, np.ones(n, "int64"), "dropped")
            return
        cnt, fired = self.windows.get() if self.windows.exists() else (0, False)
        if not cnt:
            self.handle.registerTimer(end + self.lateness)
        if end <= wm:
            if cnt and not fired:
                yield _late(key, [cnt], "first")
                fired = True
            for n in sizes:
                marks = np.full(n, "update", object)
                if n and not fired:
                    marks[0], fired = "first", True
                yield _late(key, np.arange(cnt + 1, cnt + n + 1), marks)
                cnt += n
            self.windows.update((int(cnt), True))
        else:
            if not cnt:
                self.handle.registerTimer(end)
            self.windows.update((int(cnt + sum(sizes)), False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.windows.exists():
            return
        cnt, fired = self.windows.get()
        if not fired:
            yield _late(key, [cnt], "first")
        if expiredTimerInfo.getExpiryTimeInMs() >= key[2] + self.lateness:
            self.windows.clear()
        elif not fired:
            self.windows.update((cnt, True))

    def close(self) -> None:
        pass


def _late(key, cnt, mark):
    out = pd.DataFrame({"cnt": cnt, "mark": mark})
    for at, (c, v) in enumerate(zip(("key", FLUSH, "end_ms"), key, strict=True)):
        out.insert(at, c, v)
    return out


def late_window_stream(rows: DataFrame, delay: str, size_ms: int, lateness_ms: int) -> DataFrame:
    """``rows``: stream of ``key, event_id, ts`` (instant), ``arrival_ms, _flush``.

    The event-time column is not handed on, so the engine drops no late row itself."""
    r = rows.withWatermark("ts", delay)
    end = F.floor(F.unix_millis("ts") / size_ms) * size_ms + size_ms
    r = r.select("key", FLUSH, "event_id", end.cast("long").alias("end_ms"))
    return r.groupBy("key", FLUSH, "end_ms").transformWithStateInPandas(
        statefulProcessor=LateWindowProcessor(lateness_ms),
        outputStructType=f"key long, {FLUSH} boolean, end_ms long, cnt long, mark string", outputMode="Append", timeMode="EventTime")


class ThresholdProcessor(StatefulProcessor):
    """Rules and readings of a key in one state.  A rule sets the key's
    threshold, one below ``least`` removes it; a reading is compared with the one
    before it under the rule of its time, or the default."""

    def __init__(self, default: float, least: float):
        self.default, self.least = default, least

    def init(self, handle) -> None:
        self.rules = handle.getValueState("rules", "key array<string>, threshold array<double>")
        self.last = handle.getValueState("last", "key array<string>, temp array<double>")

    def handleInputRows(self, key, rows, timerValues):
        columns, out = ["key", "ts_us", "is_row", "seq", "value"], []
        rules, last = dict(_load(self.rules)), dict(_load(self.last))
        for k, _, is_row, seq, value in _sorted_rows((b[columns] for b in rows), ["ts_us", "is_row", "seq"]):
            if not is_row:
                if value is not None and value >= self.least:
                    rules[k] = value
                else:
                    rules.pop(k, None)
                continue
            before = last.get(k)
            if before is not None and before > 0 and value is not None and value / before > (rules.get(k) or self.default):
                out.append((k, key[1], seq, value, before))
            if value is None:
                last.pop(k, None)
            else:
                last[k] = value
        _store(self.rules, rules.items())
        _store(self.last, last.items())
        return _frame(out, ["key", FLUSH, "event_id", "temp", "last_temp"])

    def close(self) -> None:
        pass


def threshold_stream(rows: DataFrame, default: float, least: float = 1.0) -> DataFrame:
    """``rows``: stream of ``sensor_id, _flush, ts_us, is_row, seq, value``: readings
    (is_row 1, seq the event id) and rules (is_row 0, seq the rule id)."""
    return _buckets(rows, {"sensor_id": "long"}, ["ts_us", "is_row", "seq", "value"], ThresholdProcessor(default, least),
                    "event_id long, temp double, last_temp double", time_mode="None")


class HeldRuleProcessor(StatefulProcessor):
    """The rule that each key holds.  A rule that arrives
    while another is held is dropped for good; a held rule ends by its event-time
    timer, or as soon as a row at or after its end is read.  Clicks come out
    with the rule held at their time."""

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "key array<string>, alert_use_id array<long>, begin_us array<long>, end_us array<long>")

    def _keep(self, held: dict) -> None:
        _store(self.held, [(k, *v) for k, v in held.items()])
        if held:
            self.handle.registerTimer(-(-min(v[2] for v in held.values()) // 1000))

    def handleInputRows(self, key, rows, timerValues):
        columns, out = ["key", "ts_us", "is_row", "seq", "end_us"], []
        held = {k: v for k, *v in _load(self.held)}
        for k, ts, is_row, seq, end in _sorted_rows((b[columns] for b in rows), ["ts_us", "is_row", "seq"]):
            rule = held.get(k)
            if rule is not None and ts is not None and ts >= rule[2]:
                del held[k]
                rule = None
            if is_row and rule is not None and ts is not None:
                out.append((k, key[1], seq, ts, rule[0]))
            elif not is_row and rule is None and ts is not None and end is not None and end > ts:
                held[k] = (int(seq), int(ts), int(end))
        self._keep(held)
        return _frame(out, ["key", FLUSH, "event_id", "ts_us", "alert_use_id"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self._keep({k: v for k, *v in _load(self.held) if v[2] > now})
        return iter([])

    def close(self) -> None:
        pass


KEY = ["client_id", "entity_type_id", "entity_id"]


def held_rule_stream(rows: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """``rows``: stream of ``client_id, entity_type_id, entity_id, _flush, ts`` (instant),
    ``is_row, seq, end_us``: clicks (is_row 1, seq the event id) and rules (is_row 0,
    seq the rule id, end_us their end)."""
    return _buckets(rows.withWatermark("ts", delay), dict(zip(KEY, ("long", "int", "long"), strict=True)),
                    [F.unix_micros("ts").alias("ts_us"), "is_row", "seq", "end_us"], HeldRuleProcessor(),
                    "event_id long, ts_us long, alert_use_id long")


class EarlyFireProcessor(StatefulProcessor):
    """ST13: a window fires every ``step`` ms from the first one after its first row,
    and last at its end, where it is purged.  A firing sets the window's next one;
    rows are kept as counts per step, at most size / step of them a window."""

    def __init__(self, size_ms: int, step_ms: int):
        self.size, self.step = size_ms, step_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "key array<string>, tick_ms array<long>, cnt array<long>")
        self.next = handle.getValueState("next", "key array<string>, end_ms array<long>, tick_ms array<long>")

    def _end(self, tick: int) -> int:
        return (tick - 1) // self.size * self.size + self.size

    def _fire(self, key, now: int, added: Iterable[tuple[str, int, int]]) -> Iterator[pd.DataFrame]:
        """Adds (key, tick, rows) to the bucket's windows, gives what the watermark has reached."""
        counts: dict[tuple, dict[int, int]] = {}
        ticks = {(k, end): tick for k, end, tick in _load(self.next)}
        for k, tick, n in _load(self.counts):
            counts.setdefault((k, self._end(tick)), {})[tick] = n
        for k, tick, n in added:
            window = (k, self._end(tick))
            mine = counts.setdefault(window, {})
            mine[tick] = mine.get(tick, 0) + n
            ticks.setdefault(window, tick)
        out = []
        for window, tick in list(ticks.items()):
            if tick > now:
                continue
            (k, end), mine = window, counts[window]
            total = sum(n for t, n in mine.items() if t < tick)
            while tick <= min(now, end):
                total += mine.get(tick, 0)
                out.append((k, key[1], end, tick, total))
                tick += self.step
            if tick > end:
                del ticks[window], counts[window]
            else:
                ticks[window] = tick
        _store(self.counts, [(k, t, n) for (k, _), mine in counts.items() for t, n in mine.items()])
        _store(self.next, [(*w, t) for w, t in ticks.items()])
        if ticks:
            self.handle.registerTimer(min(ticks.values()))
        return _frame(out, ["key", FLUSH, "end_ms", "tick_ms", "cnt"])

    def handleInputRows(self, key, rows, timerValues):
        batch = pd.concat([b[["key", "ts_ms"]] for b in rows]).dropna(subset="ts_ms")
        tick = batch["ts_ms"].astype("int64") // self.step * self.step + self.step
        sizes = batch.groupby([batch["key"], tick]).size()
        # in the order of ticks: a window's first firing is after its first row
        added = sorted(((k, int(t), int(n)) for (k, t), n in sizes.items()), key=lambda x: x[1])
        return self._fire(key, timerValues.getCurrentWatermarkInMs(), added)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        return self._fire(key, timerValues.getCurrentWatermarkInMs(), [])

    def close(self) -> None:
        pass


def early_fire_stream(rows: DataFrame, size_ms: int, step_ms: int = 1000, delay: str = "0 seconds") -> DataFrame:
    """``rows``: stream of ``sensor_id, _flush, ts`` (instant)."""
    return _buckets(rows.withWatermark("ts", delay), {"sensor_id": "long"}, [F.unix_millis("ts").alias("ts_ms")],
                    EarlyFireProcessor(size_ms, step_ms), "end_ms long, tick_ms long, cnt long")


class RetryJoinProcessor(StatefulProcessor):
    """A trade is joined with the customer row that arrived last; one that finds
    none waits, and is asked again when the watermark reaches its time, by which
    the row may have come.  A trade already behind the watermark does not wait."""

    def init(self, handle) -> None:
        self.handle = handle
        self.customer = handle.getValueState("customer", "key array<string>, info array<string>")
        self.waiting = handle.getValueState("waiting", "key array<string>, trade_id array<long>, ts_ms array<long>")

    def _answer(self, key, wm: int, info: dict) -> tuple[list[tuple], dict]:
        """What the watermark has reached, answered, and what goes on waiting; a trade waits once."""
        waiting = {(k, trade): ts for k, trade, ts in _load(self.waiting)}
        out = [(k, key[1], trade, info.get(k), "waited") for (k, trade), ts in waiting.items() if ts <= wm]
        return out, {w: ts for w, ts in waiting.items() if ts > wm}

    def _wait(self, waiting: dict) -> None:
        _store(self.waiting, [(*w, ts) for w, ts in waiting.items()])
        if waiting:
            self.handle.registerTimer(min(waiting.values()))

    def handleInputRows(self, key, rows, timerValues):
        wm, info = timerValues.getCurrentWatermarkInMs(), dict(_load(self.customer))
        # what the watermark has reached is answered before the rows of this batch
        out, waiting = self._answer(key, wm, info)
        columns = ["key", "arrival_ms", "event_id", "is_trade", "ts_ms", "info"]
        for k, _, event, is_trade, ts, new in _sorted_rows((b[columns] for b in rows), ["arrival_ms", "event_id"]):
            if not is_trade:
                if new is None:
                    info.pop(k, None)
                else:
                    info[k] = new
            elif k in info:
                out.append((k, key[1], event, info[k], "at once"))
            elif ts > wm:
                waiting[(k, int(event))] = int(ts)
            else:
                out.append((k, key[1], event, None, "late"))
        _store(self.customer, info.items())
        self._wait(waiting)
        return _joined(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        out, waiting = self._answer(key, timerValues.getCurrentWatermarkInMs(), dict(_load(self.customer)))
        self._wait(waiting)
        return _joined(out)

    def close(self) -> None:
        pass


def _joined(out):
    return _frame(out, ["key", FLUSH, "trade_id", "customer_info", "answered"])


def retry_join_stream(rows: DataFrame, delay: str) -> DataFrame:
    """``rows``: stream of ``customer_id, _flush, ts`` (instant), ``arrival_ms, event_id,
    is_trade, info``."""
    return _buckets(rows.withWatermark("ts", delay), {"customer_id": "long"},
                    ["arrival_ms", "event_id", "is_trade", F.unix_millis("ts").alias("ts_ms"), "info"], RetryJoinProcessor(),
                    "trade_id long, customer_info string, answered string")


class SwitchProcessor(StatefulProcessor):
    """A switch row opens a key's gate for ``open_us``, a later one prolongs it, and
    an event-time timer closes it; rows pass while it is open, its last instant too."""

    def __init__(self, open_us: int):
        self.open_us = open_us

    def init(self, handle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "key array<string>, until_us array<long>")

    def _keep(self, until: dict) -> None:
        _store(self.until, until.items())
        if until:
            self.handle.registerTimer(min(until.values()) // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        columns, out = ["key", "ts_us", "is_row", "seq", "value"], []
        until = dict(_load(self.until))
        for k, ts, is_row, seq, value in _sorted_rows((b[columns] for b in rows), ["ts_us", "is_row", "seq"]):
            if ts is None:
                continue
            if not is_row:
                until[k] = int(ts) + self.open_us
            elif k in until and ts <= until[k]:
                out.append((k, key[1], seq, ts, value))
        self._keep(until)
        return _frame(out, ["key", FLUSH, "event_id", "ts_us", "temp"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self._keep({k: t for k, t in _load(self.until) if t >= now})
        return iter([])

    def close(self) -> None:
        pass


class ExpiringJumpProcessor(StatefulProcessor):
    """ST20: a reading is compared with the one before it unless that is older than
    ``ttl_us``; a timer forgets a key that stays silent."""

    def __init__(self, ttl_us: int, ratio: float):
        self.ttl_us, self.ratio = ttl_us, ratio

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "key array<string>, temp array<double>, ts_us array<long>")

    def _keep(self, last: dict) -> None:
        _store(self.last, [(k, *v) for k, v in last.items()])
        if last:
            self.handle.registerTimer((min(ts for _, ts in last.values()) + self.ttl_us) // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        columns, out = ["key", "ts_us", "is_row", "seq", "value"], []
        last = {k: v for k, *v in _load(self.last)}
        for k, ts, _, seq, value in _sorted_rows((b[columns] for b in rows), ["seq"]):
            if ts is None:
                continue
            temp, at = last.get(k, (None, None))
            if temp is not None and temp > 0 and value is not None and ts - at < self.ttl_us and value / temp > self.ratio:
                out.append((k, key[1], seq, ts, value, temp))
            last[k] = (value, int(ts))
        self._keep(last)
        return _frame(out, ["key", FLUSH, "event_id", "ts_us", "temp", "last_temp"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self._keep({k: v for k, *v in _load(self.last) if v[1] + self.ttl_us >= now})
        return iter([])

    def close(self) -> None:
        pass


def _readings(rows: DataFrame, delay: str, processor: StatefulProcessor, schema: str) -> DataFrame:
    return _buckets(rows.withWatermark("ts", delay), {"sensor_id": "long"}, [F.unix_micros("ts").alias("ts_us"), "is_row", "seq", "value"],
                    processor, f"event_id long, ts_us long, {schema}")


def switch_stream(rows: DataFrame, open_us: int, delay: str = "0 seconds") -> DataFrame:
    """``rows``: stream of ``sensor_id, _flush, ts`` (instant), ``is_row, seq, value``:
    readings (is_row 1, seq the event id, value) and switches (is_row 0)."""
    return _readings(rows, delay, SwitchProcessor(open_us), "temp double")


def expiring_jump_stream(rows: DataFrame, ttl_us: int, ratio: float, delay: str = "0 seconds") -> DataFrame:
    """``rows`` as in ``switch_stream``, readings only."""
    return _readings(rows, delay, ExpiringJumpProcessor(ttl_us, ratio), "temp double, last_temp double")
