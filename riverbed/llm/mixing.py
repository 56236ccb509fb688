"""Mixing sources to target weights by Pareto order sampling.

Every source has a target size.  ``target / size`` copies of each of its
documents are due: the whole part is taken for certain, the rest is an
inclusion probability p.  A document's random number u gives its odds
``u / (1 - u)``, divided by ``p / (1 - p)``; a source takes documents in rising
order of that quotient until its target is met as nearly as the order allows,
a sample of fixed size with unequal probabilities between sources.

The cut in that order is found digit by digit: the rank is a 32-bit number, and
each of four rounds sums sizes by source and next digit, at most 256 sums a
source, and picks the digit where the target falls.  No source is sorted or
gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.frames import fresh, materialize, ready

WEIGHTS, SHARE, MOST_COPIES = (5, 2, 1), 1.5, 2
#: Bits of a rank, and of one round's digit.
RANK_BITS, DIGIT_BITS = 32, 8


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(id_col: Column, text: Column) -> Column:
    """A document's random number in (0, 1), from its id and text alone."""
    # hexadecimal digits of an MD5, 48 bits of them, so any engine gives the same
    parts = F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    top = F.conv(F.substring(F.md5(parts.cast("binary")), 1, 12), 16, 10).cast("double")
    return (top + F.lit(0.5)) / F.lit(float(1 << 48))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, get the weights in turn and ``share`` of
    all sizes in proportion; a target stops at ``most`` times its source's size
    and the excess is shared anew by weight until none is above.  In order of
    size per weight the stopped sources come first, so one running sum over this
    table (one row a source) finds them."""
    total = Window.partitionBy(F.lit(0))
    cap = F.col("source_size").cast("double") * most
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(total.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("cap", cap).withColumn("w", w)
    t = t.withColumn("budget", F.lit(share) * F.sum(F.col("source_size").cast("double")).over(total))
    order = total.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0))
    rest = F.sum("w").over(total) - F.coalesce(F.sum("w").over(upto), F.lit(0.0))
    t = t.withColumn("level", left / rest).withColumn("full", F.col("cap") <= F.col("w") * F.col("level"))
    # the first source that isn't full fixes the level of all that aren't
    level = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("w")).alias("o"), "level"))).over(total)["level"]
    return t.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * level)).select(
        "source", "source_size", "target")


def _rank(p: Column, u: Column) -> Column:
    """Pareto quotient q as q / (1 + q), cut to RANK_BITS bits."""
    q = (u / (F.lit(1.0) - u)) * ((F.lit(1.0) - p) / p)
    return F.when(p > 0, F.floor(q / (q + F.lit(1.0)) * F.lit(float(1 << RANK_BITS)))).cast("long")


def plan_sources(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """Per source ``source, source_size, target, whole, p, cut`` from
    ``source, size, u`` per document: ``whole`` copies of each document, one more
    of those whose rank is at most ``cut``."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, share, most)
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = plan.withColumn("whole", F.floor(due).cast("long")).withColumn("p", due - F.floor(due))
    plan = plan.withColumn("need", F.col("target") - (F.col("whole") * F.col("source_size")).cast("double"))
    plan = materialize(plan.withColumn("head", F.lit(0).cast("long")).withColumn("below", F.lit(0).cast("long")), "plan")
    for shift in range(RANK_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        here = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(rows["source"])
        here = here.withColumn("rank", _rank(F.col("p"), F.col("u")))
        here = here.filter(F.shiftrightunsigned("rank", shift + DIGIT_BITS) == F.col("head"))
        digit = here.groupBy("source", "need", "below", "head",
                             F.shiftright("rank", shift).alias("next")).agg(F.sum("size").alias("s"))
        order = Window.partitionBy("source").orderBy("next")
        digit = digit.withColumn("upto", F.sum("s").over(order) + F.col("below"))
        # the digit before which the need is not yet met: the last one that begins at or below it
        begins = digit.filter((F.col("upto") - F.col("s")).cast("double") <= F.col("need"))
        pick = begins.groupBy("source").agg(F.max(F.struct("next", (F.col("upto") - F.col("s")).alias("below"),
                                                           "s")).alias("d"))
        plan = plan.drop("last").join(pick.withColumnRenamed("source", "src"),
                                      plan["source"].eqNullSafe(F.col("src")), "left")
        plan = materialize(plan.select(
            "source", "source_size", "target", "whole", "p", "need",
            F.coalesce("d.next", F.shiftleft("head", DIGIT_BITS)).alias("head"),
            F.coalesce("d.below", "below").alias("below"), F.coalesce("d.s", F.lit(0)).alias("last")), "plan")
    # documents of the last rank are in if that brings the sum nearer
    near = F.col("below").cast("double") * 2 + F.col("last").cast("double") <= F.col("need") * 2
    return plan.withColumn("cut", F.when(F.col("p") > 0, F.col("head") - F.when(near, 0).otherwise(1)).otherwise(-1)).select(
        "source", "source_size", "target", "whole", "p", "cut")


def _copies() -> Column:
    extra = F.coalesce(_rank(F.col("p"), F.col("u")) <= F.col("cut"), F.lit(False))
    return F.col("whole") + extra.cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row ``doc_id, size, source_size, target, taken, copies``.

    size counts words (null text: 0); taken is ``copies * size``, copies at most
    ``most``.  A null source is a source of its own, the last in order.  Rows with
    equal id and text share their random number and are taken alike.  Sources
    without words have target 0 and take nothing.  Other columns are ignored.  No
    rows: an empty table."""
    rows = ready(docs).select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
        uniform(F.col(id_col), F.col(text_col)).alias("u"))
    rows = materialize(rows, "sizes")
    plan = plan_sources(rows.select("source", "size", "u"), weights, share, most)
    return rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "doc_id", "size", "source_size", "target", (_copies() * F.col("size")).alias("taken"),
        _copies().alias("copies"))


def mixed_rows(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as it is taken."""
    u, *names = fresh(docs, "_u", "_source", "_whole", "_p", "_cut")
    rows = ready(docs).select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                              uniform(F.col(id_col), F.col(text_col)).alias("u"))
    plan = plan_sources(materialize(rows, "sizes"), weights, share, most)
    plan = plan.select(*[F.col(c).alias(n) for c, n in zip(("source", "whole", "p", "cut"), names, strict=True)])
    plan = materialize(plan, "plan")
    there = docs.withColumn(u, uniform(F.col(id_col), F.col(text_col)))
    out = there.join(plan, there[source_col].eqNullSafe(plan[names[0]]))
    extra = F.coalesce(_rank(F.col(names[2]), F.col(u)) <= F.col(names[3]), F.lit(False)).cast("long")
    copy = fresh(out, "copy")[0]
    return (out.withColumn(copy, F.explode(F.array_repeat(F.lit(1), (F.col(names[1]) + extra).cast("int"))))
            .select(*[out[c] for c in docs.columns]))
