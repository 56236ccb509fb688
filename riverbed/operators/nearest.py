"""Nearest point so far, without forming all (query, point) pairs.

A query sees the points of its time span in order; every point that is nearer
than all before it is a result.  The points are numbered by time, so a span is a
range of numbers however the points crowd in time, and the range is asked in
slices that grow ``GROW``-fold (the second one is short):

* the first slice is the rest of the query's own block of ``FIRST`` points, met as one array;
* a later slice is one to ``GROW`` aligned blocks of numbers.  Only points nearer than
  the query's best so far can matter, so points are met through (block, grid cell)
  with a cell side from the query's own radius: powers of two, at least the
  radius twice, so a query looks into at most four cells of a block.  Of points at
  one place a block keeps the first: no later one can be nearer.

With points in no special order a slice adds about ``GROW`` - 1 nearer points, so a query
meets a number of points that grows with the logarithm of its span.  Where many
points crowd in one cell outside the best distance they are still compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riverbed.functions.geo import DEG_LEN, distance
from riverbed.session import materialize

#: Points of a query's first slice, at the most.
FIRST = 64
#: How much longer each slice is than the one before: a round reads all points once.
GROW = 4
#: Stretches of time that a query's span is cut into, at the most, to find the points it can see.
STRETCHES = 64
#: Radii are padded by this share against rounding; cells have at least this exponent.
PAD = 1 + 1e-9
LEAST_LEVEL = -40


def _in_time_order(queries: DataFrame, points: DataFrame, query_id: str, point_id: str) -> tuple[DataFrame, DataFrame]:
    """Points with their number ``p`` in the order of (us, id), queries with the numbers
    ``s`` (first point of the span) and ``e`` (first one after it), from one written table."""
    point = F.struct(*points.columns)
    none = F.lit(None).cast(points.select(point.alias("r")).schema["r"].dataType)
    q = F.struct(F.col(query_id), "lon", "lat")
    no_q = F.lit(None).cast(queries.select(q.alias("q")).schema["q"].dataType)
    ends = queries.select(q.alias("q"), F.explode(F.array(
        F.struct(F.col("from_us").alias("us"), F.lit(0).alias("kind")),
        F.struct(F.col("upto_us").alias("us"), F.lit(2).alias("kind")))).alias("end"))
    u = points.select("us", F.lit(1).alias("kind"), F.col(point_id).alias("id"), no_q.alias("q"), point.alias("r")).unionByName(
        ends.select("end.us", "end.kind", F.col(f"q.{query_id}").alias("id"), "q", none.alias("r")))
    u = u.filter(F.col("us").isNotNull())
    order = ["us", "kind", "id"]
    placed = materialize(u.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("place", F.monotonically_increasing_id()), "nearest-order")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    is_point = F.when(F.col("kind") == 1, 1).otherwise(0)
    sizes = placed.groupBy("part").agg(F.sum(is_point).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    upto = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("own", F.coalesce(F.sum(is_point).over(upto), F.lit(0))).join(before, "part")
    placed = materialize(placed.select("kind", (F.col("before") + F.col("own")).alias("p"), "q", "r"), "nearest-numbers")
    spans = placed.filter("kind <> 1").groupBy("q").agg(
        F.max(F.when(F.col("kind") == 0, F.col("p"))).alias("s"), F.max(F.when(F.col("kind") == 2, F.col("p"))).alias("e"))
    return placed.filter("kind = 1").select("p", "r"), spans.filter("s < e")


def _nearer(query_rows: DataFrame) -> DataFrame:
    """Per query with an array ``ps`` of the points of its block: those of its span nearer than all before.
    Numbers have no gaps, so the span is a slice of the block."""
    first = F.col("ps")[0]["p"]
    mine = F.slice("ps", (F.col("s") - first + 1).cast("int"), F.least(F.col("e") - F.col("s"), F.lit(FIRST)).cast("int"))
    seen = F.transform(mine, lambda x: F.struct(
        x["p"].alias("p"), distance(F.col("q.lon"), F.col("q.lat"), x["x"], x["y"]).alias("distance")))
    query_rows = query_rows.select("q", seen.alias("seen"))
    falling = F.aggregate("seen", F.slice("seen", 1, 0), lambda acc, x: F.when(
        (F.size(acc) == 0) | (x["distance"] < F.try_element_at(acc, F.lit(-1))["distance"]), F.concat(acc, F.array(x))).otherwise(acc))
    return query_rows.select("q", F.explode(falling).alias("f")).select("q", "f.p", "f.distance")


def nearest_so_far(queries: DataFrame, points: DataFrame, query_id: str, point_id: str) -> DataFrame:
    """Per query, every point nearer than all earlier ones of its span, with ``distance``.

    ``queries``: ``query_id`` (one row each), ``lon``, ``lat``, ``from_us``, ``upto_us``
    (both ends belong to the span).  ``points``: ``point_id``, ``us``, ``lon``, ``lat`` and
    others, which come out too; points of one instant are in the order of their id.
    Queries and points without a time or a place have no part.  Tables must not be empty
    of columns, but may be of rows."""
    for c in ("lon", "lat"):
        queries, points = queries.filter(F.col(c).isNotNull()), points.filter(F.col(c).isNotNull())
    pts, spans = _in_time_order(queries, points, query_id, point_id)
    # a search carries numbers and places; the other columns come in at the end
    placed = pts.select("p", F.col("r.lon").alias("x"), F.col("r.lat").alias("y"))
    far = distance("q.lon", "q.lat", "x", "y")
    # no degree of longitude is shorter than this share of a degree of latitude
    squeeze = max(placed.agg(F.min(F.abs(F.cos("y")))).first()[0] or 0.0, 1e-12)

    start = f"(s div {FIRST} + 1) * {FIRST}"
    blocks = placed.groupBy(F.expr(f"p div {FIRST}").alias("block")).agg(F.sort_array(F.collect_list(F.struct("p", "x", "y"))).alias("ps"))
    more = materialize(_nearer(spans.withColumn("block", F.expr(f"s div {FIRST}")).join(blocks, "block")), "nearest-found")
    found, asking = more, spans.withColumn("best", F.lit(None).cast("double"))
    # a query sees but a part of its own block, half on average: the slice after it is short
    width, wider = FIRST, 2 * FIRST
    while True:
        stop = f"({start} div {wider} + 1) * {wider}"
        best = more.groupBy("q").agg(F.min("distance").alias("nearer"))
        alive = asking.filter(F.expr(f"{start} < e")).join(best, "q", "left")
        alive = alive.withColumn("best", F.coalesce("nearer", "best")).drop("nearer").filter("best > 0")
        asking = materialize(alive, "nearest-asking")
        r = F.col("best") * (PAD / DEG_LEN)
        alive = asking.withColumn("r0", r).withColumn(
            "level", F.greatest(F.ceil(F.log2(2 * F.col("r0"))).cast("int"), F.lit(LEAST_LEVEL)))
        # at most one level for each exponent of a double
        levels = sorted(row[0] for row in alive.select("level").distinct().collect())
        if not levels:
            break
        side = F.pow(F.lit(2.0), F.col("level"))
        cells = lambda v, share: F.sequence(F.floor((v * share - F.col("r0")) / side), F.floor((v * share + F.col("r0")) / side))
        asked = alive.select("q", "e", "best", "r0", "level", F.explode(F.expr(
            f"sequence({start} div {width}, (least({stop}, e) - 1) div {width})")).alias("block"))
        asked = asked.withColumn("gx", F.explode(cells(F.col("q.lon"), squeeze)))
        asked = asked.withColumn("gy", F.explode(cells(F.col("q.lat"), 1.0))).drop("r0")
        held = placed.groupBy(F.expr(f"p div {width}").alias("block"), "x", "y").agg(F.min("p").alias("p"))
        held = held.select("block", F.explode(F.array(*[F.lit(v) for v in levels])).alias("level"), "x", "y", "p")
        held = held.select("block", "level", F.floor(F.col("x") * squeeze / side).alias("gx"),
                           F.floor(F.col("y") / side).alias("gy"), "p", "x", "y")
        met = asked.join(held, ["block", "level", "gx", "gy"]).filter("p < e").withColumn("distance", far)
        more = materialize(met.filter(F.col("distance") < F.col("best")).select("q", "p", "distance"), "nearest-found")
        found = found.unionByName(more)
        start, width, wider = stop, wider, GROW * wider
    earlier = Window.partitionBy("q").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("least", F.min("distance").over(earlier))
    found = found.filter(F.col("least").isNull() | (F.col("distance") < F.col("least"))).join(pts, "p")
    return found.select(f"q.{query_id}", *[F.col("r")[c].alias(c) for c in points.columns if c not in ("lon", "lat")], "distance")


def nearest_with_reset(queries: DataFrame, points: DataFrame, query_id: str, point_id: str, retention_us: int) -> DataFrame:
    """``nearest_so_far`` whose memory of the best goes once no nearer point came for more
    than ``retention_us``; the next point then is nearest again.  One search a generation
    of resets; only queries with time left go on, among the points they can still see."""
    kept, spans = None, materialize(queries, "nearest-queries")
    while True:
        found = materialize(nearest_so_far(spans, points, query_id, point_id), "nearest-generation")
        found = found.join(spans.select(query_id, F.col("upto_us").alias("_upto")), query_id)
        by_time = Window.partitionBy(query_id).orderBy("us", point_id)
        quiet = F.coalesce(F.lead("us").over(by_time), F.col("_upto")) > F.col("us") + F.lit(retention_us)
        found = found.withColumn("_quiet", quiet.cast("int"))
        found = found.withColumn("_resets", F.coalesce(F.sum("_quiet").over(by_time.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        found = found.filter("_resets = 0")
        mine = found.drop("_upto", "_quiet", "_resets")
        kept = mine if kept is None else kept.unionByName(mine)
        again = found.filter("_quiet = 1").select(query_id, (F.col("us") + F.lit(retention_us + 1)).alias("from_us"))
        spans = materialize(spans.drop("from_us").join(again, query_id), "nearest-queries")
        if spans.isEmpty():
            return kept
        points = materialize(near_in_time(spans, points), "nearest-points")


def near_in_time(queries: DataFrame, points: DataFrame) -> DataFrame:
    """The points in stretches of time that the span of a query touches: all that any query
    sees, and few others.  A stretch is as long as the longest span's share of ``STRETCHES``."""
    longest = queries.agg(F.max(F.col("upto_us") - F.col("from_us"))).first()[0]
    width = max(1, -(-(longest or 0) // STRETCHES))
    touched = queries.select(F.explode(F.expr(f"sequence(floor(from_us / {width}), floor(upto_us / {width}))")).alias("_stretch"))
    return points.withColumn("_stretch", F.expr(f"floor(us / {width})")).join(
        touched.distinct(), "_stretch", "left_semi").drop("_stretch")
