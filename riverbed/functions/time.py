"""Time helpers (F10, F11): epoch conversions, durations, zone shifts.

Event times are ``TIMESTAMP_NTZ`` (wall clock in UTC) in batch plans, which
keeps results independent of the session zone.  Streaming plans need
``TIMESTAMP`` for watermarks: ``to_instant`` converts assuming UTC wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def minutes_between(start, end) -> Column:
    """(end − start) in minutes as a double: millisecond difference / 60000.0."""
    return F.timestamp_diff("MILLISECOND", _c(start), _c(end)) / F.lit(60000.0)


def millis_between(start, end) -> Column:
    return F.timestamp_diff("MILLISECOND", _c(start), _c(end))


def epoch_millis(ts) -> Column:
    """Milliseconds since the epoch of a UTC wall-clock timestamp (NTZ or instant)."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts).cast("timestamp_ntz"))


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch of a UTC wall-clock timestamp."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _c(ts).cast("timestamp_ntz"))


def from_epoch_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", _c(us), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def from_epoch_millis(ms) -> Column:
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def from_epoch_seconds(s) -> Column:
    return F.timestamp_add("SECOND", _c(s), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def to_instant(ts) -> Column:
    """NTZ wall clock (UTC) → TIMESTAMP instant, independent of the session zone.

    The cast reads the wall clock in the session zone; shifting it back by the
    session offset gives the instant whose UTC wall clock is the input."""
    return F.from_utc_timestamp(_c(ts).cast("timestamp"), F.current_timezone())


def to_wall_clock(ts) -> Column:
    """TIMESTAMP instant → NTZ wall clock in UTC, independent of the session zone."""
    return F.to_utc_timestamp(_c(ts), F.current_timezone()).cast("timestamp_ntz")


def utc_to_zone(ts, zone: str) -> Column:
    """UTC wall clock → wall clock in ``zone`` (e.g. America/Los_Angeles)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts).cast("timestamp_ntz"))
