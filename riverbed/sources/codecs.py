"""Line codecs for the reference's text formats, as Spark expressions.

Parsing is ``split`` + casts over a text column, so a file, a message value
(binary → string) or a stream of lines all decode the same way.  A line with
the wrong number of fields fails the job (``raise_error``), as the reference
throws on an invalid record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.functions.time import to_wall_clock

# fixed values: text formats of the reference's record types
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CAR_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"
CAR_SPLIT = "(,|;)\\s*"
MAIL_RECORD_DELIM = "##//##"
MAIL_FIELD_DELIM = "#|#"
EPOCH_TEXT = "1970-01-01 00:00:00"


def _fmt(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, TIME_FORMAT), F.lit(EPOCH_TEXT))


def ride_to_line(rides: DataFrame) -> Column:
    """rideId,START|END,eventTime,otherTime,startLon,startLat,endLon,endLat,passengers,taxiId,driverId.
    The event's own time comes first (end time for an END), as in the data files."""
    first = F.when(F.col("is_start"), F.col("start_time")).otherwise(F.col("end_time"))
    second = F.when(F.col("is_start"), F.col("end_time")).otherwise(F.col("start_time"))
    return F.concat_ws(",", F.col("ride_id").cast("string"),
                       F.when(F.col("is_start"), "START").otherwise("END"), _fmt(first), _fmt(second),
                       *[F.col(c).cast("string") for c in ("start_lon", "start_lat", "end_lon", "end_lat")],
                       *[F.col(c).cast("string") for c in ("passenger_cnt", "taxi_id", "driver_id")])


def _checked_tokens(line: Column, sep: str, n: int, what: str) -> Column:
    toks = F.split(line, sep)
    return F.when(F.size(toks) == n, toks).otherwise(
        F.raise_error(F.concat(F.lit(f"Invalid {what} record: "), line)))


def _float_or_zero(tok: Column) -> Column:
    return F.when(F.length(tok) > 0, tok.cast("double")).otherwise(F.lit(0.0))


def parse_ride_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Inverse of ``ride_to_line``: START/END swaps the two time fields, an empty
    coordinate is 0.0, a wrong field count fails the job (IO1)."""
    t = lines.select(_checked_tokens(F.col(col), ",", 11, "ride").alias("t"))
    kind = F.col("t")[1]
    is_start = F.when(kind == "START", True).when(kind == "END", False).otherwise(
        F.raise_error(F.lit("Invalid ride kind")))
    a, b = F.to_timestamp_ntz(F.col("t")[2], F.lit(TIME_FORMAT)), F.to_timestamp_ntz(F.col("t")[3], F.lit(TIME_FORMAT))
    return t.select(
        F.col("t")[0].cast("bigint").alias("ride_id"), is_start.alias("is_start"),
        F.when(kind == "START", a).otherwise(b).alias("start_time"),
        F.when(kind == "START", b).otherwise(a).alias("end_time"),
        *[_float_or_zero(F.col("t")[i]).alias(c) for i, c in
          zip(range(4, 8), ("start_lon", "start_lat", "end_lon", "end_lat"))],
        F.col("t")[8].cast("smallint").alias("passenger_cnt"), F.col("t")[9].cast("bigint").alias("taxi_id"),
        F.col("t")[10].cast("bigint").alias("driver_id"))


def fare_to_line(fares: DataFrame) -> Column:
    """rideId,taxiId,driverId,startTime,paymentType,tip,tolls,totalFare (IO4)."""
    return F.concat_ws(",", *[F.col(c).cast("string") for c in ("ride_id", "taxi_id", "driver_id")],
                       _fmt(F.col("start_time")), F.col("payment_type"),
                       *[F.col(c).cast("string") for c in ("tip", "tolls", "total_fare")])


def parse_fare_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    t = lines.select(_checked_tokens(F.col(col), ",", 8, "fare").alias("t"))
    return t.select(
        F.col("t")[0].cast("bigint").alias("ride_id"), F.col("t")[1].cast("bigint").alias("taxi_id"),
        F.col("t")[2].cast("bigint").alias("driver_id"),
        F.to_timestamp_ntz(F.col("t")[3], F.lit(TIME_FORMAT)).alias("start_time"), F.col("t")[4].alias("payment_type"),
        *[_float_or_zero(F.col("t")[i]).alias(c) for i, c in zip(range(5, 8), ("tip", "tolls", "total_fare"))])


def car_to_line(cars: DataFrame) -> Column:
    """23 fields separated by ',' or ';' plus optional spaces; car id, event id,
    speed, throttle and an ISO time with offset at their fixed positions."""
    f = [F.lit("")] * 23
    f[0], f[1] = F.col("car_id").cast("string"), F.col("id").cast("string")
    f[9], f[12] = F.col("speed").cast("string"), F.col("throttle").cast("string")
    f[22] = F.concat(F.date_format(F.col("event_time"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+0000"))
    head = F.concat_ws(", ", *f[:12])
    return F.concat_ws(";", head, *f[12:])


def parse_car_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """IO3: split on ``(,|;)\\s*``, 23 fields required, nine picked by position."""
    t = lines.select(_checked_tokens(F.col(col), CAR_SPLIT, 23, "car").alias("t"))
    ts = to_wall_clock(F.to_timestamp(F.col("t")[22], CAR_TIME_FORMAT))
    return t.select(
        F.col("t")[1].cast("bigint").alias("id"), F.col("t")[0].cast("bigint").alias("car_id"), ts.alias("event_time"),
        *[_float_or_zero(F.col("t")[i]).alias(c) for i, c in
          ((20, "longitude"), (21, "latitude"), (7, "consumption"), (9, "speed"), (12, "throttle"), (19, "engineload"))])


def mail_to_record(mails: DataFrame) -> Column:
    """messageId #|# time #|# sender #|# subject #|# body #|# replyTo (one record)."""
    return F.concat_ws(MAIL_FIELD_DELIM, "message_id", F.date_format("sent", TIME_FORMAT), "sender",
                       F.concat(F.lit("thread "), F.split("message_id", "-")[0]), "body", "reply_to")


def parse_mail_records(records: DataFrame, mask: str, names: list[str], col: str = "value") -> DataFrame:
    """Split a ``#|#`` record and keep the fields whose mask position is '1' (IO5)."""
    toks = F.split(F.col(col), MAIL_FIELD_DELIM.replace("|", "\\|"))
    keep = [i for i, m in enumerate(mask) if m == "1"]
    if len(keep) != len(names):
        raise ValueError("one name per selected field")
    return records.filter(F.length(F.col(col)) > 0).select(*[toks[i].alias(n) for i, n in zip(keep, names)])
