"""Source and sink formats: ride/fare CSV lines, message values, car text lines,
delimited mail records, mail archives, time-series points, heartbeat lines.

Each query writes a whole derived table in the format to a fresh folder under
the shared checkpoint directory and reads it back through the parser, so the
result must equal the table it started from (up to what the format keeps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_millis
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.session import scratch_path
from riverbed.sources import codecs, views

RIDES_BACK_SQL = with_views("rides") + """
SELECT ride_id, is_start, date_trunc('second', start_time) AS start_time,
       coalesce(date_trunc('second', end_time), TIMESTAMP '1970-01-01 00:00:00') AS end_time,
       start_lon, start_lat, end_lon, end_lat, CAST(passenger_cnt AS SMALLINT) AS passenger_cnt, taxi_id, driver_id
FROM rides"""


def _roundtrip_text(spark: SparkSession, lines: DataFrame, name: str, line_sep: str | None = None) -> DataFrame:
    path = scratch_path(spark, name)
    w = lines.write.mode("error")
    r = spark.read
    if line_sep is not None:
        w, r = w.option("lineSep", line_sep), r.option("lineSep", line_sep)
    w.text(path)
    return r.text(path)


@query("scan_rides_csv", RIDES_BACK_SQL)
def scan_rides_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides written as CSV lines and read back by the ride parser (IO1)."""
    r = views.rides(spark, sf_dir)
    back = _roundtrip_text(spark, r.select(codecs.ride_to_line(r).alias("value")), "rides-csv")
    return codecs.parse_ride_lines(back)


@query("codec_ride_roundtrip", RIDES_BACK_SQL)
def codec_ride_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides encoded as message values (UTF-8 bytes of the CSV line) and decoded
    back — the value codec of the message-topic source and sink (IO4, IO9, IO10)."""
    r = views.rides(spark, sf_dir)
    msgs = r.select(F.encode(codecs.ride_to_line(r), "UTF-8").alias("value"))
    return codecs.parse_ride_lines(msgs.select(F.decode("value", "UTF-8").alias("value")))


@query("scan_fares_csv", with_views("fares") + """
SELECT ride_id, taxi_id, driver_id, date_trunc('second', start_time) AS start_time, payment_type, tip, tolls, total_fare
FROM fares""")
def scan_fares_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fares written as 8-field CSV lines and read back (IO2)."""
    f = views.fares(spark, sf_dir)
    back = _roundtrip_text(spark, f.select(codecs.fare_to_line(f).alias("value")), "fares-csv")
    return codecs.parse_fare_lines(back)


@query("scan_cars_text", with_views("cars") + """
SELECT id, car_id, date_trunc('second', event_time) AS event_time, 0e0 AS longitude, 0e0 AS latitude,
       0e0 AS consumption, speed, CAST(throttle AS DOUBLE) AS throttle, 0e0 AS engineload FROM cars""")
def scan_cars_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Car events as 23-field text lines split on ``(,|;)\\s*`` with an ISO time
    and offset; empty numeric fields read as 0.0 (IO3)."""
    c = views.cars(spark, sf_dir)
    back = _roundtrip_text(spark, c.select(codecs.car_to_line(c).alias("value")), "cars-text")
    return codecs.parse_car_lines(back)


@query("scan_delimited_mails", with_views("mails") + """
SELECT message_id, strftime(sent, '%Y-%m-%d %H:%M:%S') AS time, sender, reply_to FROM mails""")
def scan_delimited_mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail records separated by ``##//##`` with ``#|#`` between fields; a
    position mask picks the fields to read (IO5)."""
    m = views.mails(spark, sf_dir)
    back = _roundtrip_text(spark, m.select(codecs.mail_to_record(m).alias("value")), "mails-delim",
                           line_sep=codecs.MAIL_RECORD_DELIM)
    return codecs.parse_mail_records(back, "111001", ["message_id", "time", "sender", "reply_to"])


ARCHIVE_SEP = "From dev-return"
# fixed value: the time format of the delimited mail records an archive is turned into
ARCHIVE_TIME = "yyyy-MM-dd-HH:mm:ss"


def render_archive(mails: DataFrame) -> DataFrame:
    """Mails as an archive: a first line that ends in the delivery time, headers
    (names in the case of different mailers), an empty line, the body with a
    soft line break after its tenth character in every other mail."""
    part = F.split("message_id", "-")
    shout = part[1].cast("int") % 2 == 1
    name = lambda n: F.when(shout, F.lit(n.upper() + ": ")).otherwise(F.lit(n + ": "))
    line_time = F.concat(F.date_format("sent", "EEE MMM "), F.lpad(F.date_format("sent", "d"), 2, " "),
                         F.date_format("sent", " HH:mm:ss yyyy"))
    reply_hdr = F.when(F.col("reply_to") == "null", F.lit("")).otherwise(
        F.concat(name("In-Reply-To"), F.col("reply_to"), F.lit("\n")))
    body = F.when(shout, F.concat(F.substring("body", 1, 10), F.lit("=\n"), F.expr("substring(body, 11)"))
                  ).otherwise(F.col("body"))
    rec = F.concat(
        F.lit("-"), F.col("message_id"), F.lit("@example.org "), line_time, F.lit("\n"),
        name("From"), F.col("sender"), F.lit("\n"), name("Subject"), F.lit("thread "), part[0], F.lit("\n"),
        name("Message-ID"), F.col("message_id"), F.lit("\n"), reply_hdr, F.lit("\n"), body, F.lit("\n"))
    return mails.select(rec.alias("value"))


def parse_archive(records: DataFrame) -> DataFrame:
    """Archive records (cut before each ``From dev-return``) → (message id, time,
    sender, subject, body, reply-to), one per message id (IO7).

    The time is the last 24 characters of the first line.  Header names are
    read in either case, the last of a name counts, and a header takes the rest
    of its line.  The body begins with the first blank line (kept); each line
    ends in a line feed, but for a soft break (``=`` at the end), which joins it
    to the next.  Records without a readable time, id, sender, subject or body,
    or with a delimiter inside a field, are left out; reply-to defaults to
    "null".  Of records with one id the least stays.
    """
    lines = F.split(F.regexp_replace(F.concat(F.lit(ARCHIVE_SEP), F.col("value")), "\\n+$", ""), "\n")
    # 0 without a blank line; the slices are then of no use but must stay valid
    blank = F.array_position(F.transform(F.col("_lines"), lambda x: x.rlike("^[\\x00-\\x20]*$")), True).cast("int")
    first = F.col("_lines")[0]

    def header(name: str):
        found = F.filter(F.col("_head"), lambda x: F.startswith(F.lower(x), F.lit(name + ": ")))
        return F.try_element_at(
            F.transform(found, lambda x: F.substring(x, len(name) + 3, 1 << 30)), F.lit(-1))

    stamp = F.regexp_extract(F.regexp_replace(F.substring(first, -24, 24), "\\s+", " "), "^[A-Za-z]{3} (.*)$", 1)
    body = F.array_join(F.transform(
        F.slice(F.col("_lines"), F.greatest(F.col("_blank"), F.lit(1)), F.size("_lines")),
        lambda x: F.when(F.endswith(x, F.lit("=")), F.regexp_replace(x, "=$", "")).otherwise(F.concat(x, F.lit("\n")))), "")
    out = (records.filter(F.length("value") > 0).select(lines.alias("_lines")).withColumn("_blank", blank)
           .filter((F.col("_blank") > 1) & (F.length(first) >= 24))
           .withColumn("_head", F.slice(F.col("_lines"), F.lit(2), F.greatest(F.col("_blank") - 2, F.lit(0))))
           .select(header("message-id").alias("message_id"),
                   F.date_format(F.try_to_timestamp(stamp, F.lit("MMM d HH:mm:ss yyyy")), ARCHIVE_TIME).alias("time"),
                   header("from").alias("sender"), header("subject").alias("subject"), body.alias("body"),
                   F.coalesce(header("in-reply-to"), F.lit("null")).alias("reply_to")))
    fields = ["message_id", "time", "sender", "subject", "body", "reply_to"]
    complete = F.lit(True)
    for c in fields:
        complete = complete & F.col(c).isNotNull() \
            & ~F.col(c).contains(codecs.MAIL_FIELD_DELIM) & ~F.col(c).contains(codecs.MAIL_RECORD_DELIM)
    kept = F.min_by(F.struct(*fields[1:]), F.struct(*fields[1:]))
    return out.filter(complete).groupBy("message_id").agg(kept.alias("r")).select("message_id", "r.*")


@query("mail_archive_to_records", with_views("mails") + """
SELECT message_id, strftime(sent, '%Y-%m-%d-%H:%M:%S') AS time, sender, 'thread ' || split_part(message_id, '-', 1) AS subject,
       chr(10) || replace(body, '=' || chr(10), '') || chr(10) AS body, reply_to FROM mails""")
def mail_archive_to_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive text rendered from the mails, split on the archive's record marker
    and parsed back into records (IO7)."""
    back = _roundtrip_text(spark, render_archive(views.mails(spark, sf_dir)), "mail-archive", line_sep=ARCHIVE_SEP)
    return parse_archive(back)


@query("timeseries_points", with_views("sensors") + """
SELECT 'temperature,key=' || sensor_id || ' value=' || CAST(temp AS VARCHAR) || ' ' || (epoch_us(ts) // 1000) AS line
FROM sensors""")
def timeseries_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as time-series points: measurement, tag ``key``, field, millis (IO12)."""
    return views.sensors(spark, sf_dir).select(point_line().alias("line"))


def point_line() -> Column:
    return F.concat(F.lit("temperature,key="), F.col("sensor_id").cast("string"), F.lit(" value="),
                    F.col("temp").cast("string"), F.lit(" "), epoch_millis("ts").cast("string"))


@query("heartbeat_parse", with_views("beats") + """
SELECT CAST(instance_id AS VARCHAR) AS instance_id, CASE WHEN instance_id % 2 = 0 THEN 'web' ELSE 'db' END AS server_type,
       product_id, CAST(customer_id AS VARCHAR) AS customer_id, epoch_us(ts) // 1000000 AS ts_seconds FROM beats""")
def heartbeat_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heartbeat CSV lines (time in epoch seconds), empty lines dropped (IO20)."""
    b = views.beats(spark, sf_dir)
    line = F.concat_ws(",", F.col("instance_id").cast("string"),
                       F.when(F.col("instance_id") % 2 == 0, "web").otherwise("db"), "product_id",
                       F.col("customer_id").cast("string"), F.floor(epoch_millis("ts") / 1000).cast("string"))
    # every tenth heartbeat is followed by an empty line, as in hand-written input files
    text = F.when(F.col("event_id") % 10 == 0, F.concat(line, F.lit("\n"))).otherwise(line)
    back = _roundtrip_text(spark, b.select(text.alias("value")), "beats")
    t = back.filter(F.length("value") > 0).select(F.split("value", ",").alias("t"))
    return t.select(F.col("t")[0].alias("instance_id"), F.col("t")[1].alias("server_type"), F.col("t")[2].alias("product_id"),
                    F.col("t")[3].alias("customer_id"), F.col("t")[4].cast("bigint").alias("ts_seconds"))
