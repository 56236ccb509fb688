"""Predicates that arrive as text while rows flow (PF12).

A rule is a row: id, arrival time, predicate over the row's columns and
``watermark`` (epoch ms).  From its arrival until the next rule's, a rule is asked of
every row; when it arrives, it is also asked of the newest row of each key.  The
texts must be compiled into the plan, so the rules are read by the driver, at most
``MAX_RULES`` of them; more are an error, not cut off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.functions.time import epoch_micros, epoch_millis
from riverbed.operators.running import below

MAX_RULES = 1000


def _holds(rules: list, number: Column) -> Column:
    """Whether the predicate of the rule with this number (from 1) holds; each text is compiled once."""
    of_text: dict[str, list[int]] = {}
    for i, r in enumerate(rules, 1):
        of_text.setdefault(r["predicate"], []).append(i)
    out = F.when(F.lit(False), F.lit(False))
    for text, numbers in of_text.items():
        out = out.when(number.isin(numbers), F.expr(text))
    return F.coalesce(out, F.lit(False))


def adhoc_rules(rows: DataFrame, rules: DataFrame, key: str, time: str, order: Sequence[Column], delay_ms: int) -> DataFrame:
    """``rows`` for which a rule holds, with ``rule_id``, ``asked`` ('row': when the row
    came, 'rule': when the rule came, of the key's newest row before it) and
    ``watermark``, the time of asking less ``delay_ms``.

    ``rules``: ``rule_id, arrives, predicate``; rules without a time or a text are
    left out.  Of rules arriving together the one with the highest id stays, the
    others are asked of the newest rows only.  ``order`` ranks rows of one key after
    their time.  A null key is a key; a row without a time is never asked.

    Rows are scanned once for each way of asking.  For the second, rows are reduced
    to the newest per key and pause between two rules (a partial aggregate, so a
    hot key shrinks before the shuffle); a key's window holds one row per pause.
    """
    known = rules.filter("rule_id is not null and arrives is not null and predicate is not null")
    known = known.select("rule_id", "predicate", "arrives", epoch_micros("arrives").alias("us"), epoch_millis("arrives").alias("ms"))
    found = known.orderBy("us", "rule_id").limit(MAX_RULES + 1).collect()
    if len(found) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    spark = rows.sparkSession
    # at most MAX_RULES rows
    table = F.broadcast(spark.createDataFrame([(i, r["rule_id"], r["ms"]) for i, r in enumerate(found, 1)],
                                              "_rule int, rule_id long, _rule_ms long"))
    # the rules that have come by then; exploded, so that it is found once a row: as a plain column
    # its expression would be copied into each branch that asks for a rule's number
    by_then = below([r["us"] for r in found], epoch_micros(time) + 1).cast("int")
    came = rows.withColumn("_rule", F.explode(F.array(by_then)))
    own = came.withColumn("watermark", epoch_millis(time) - delay_ms).filter(_holds(found, F.col("_rule")))
    own = own.join(table, "_rule").withColumn("asked", F.lit("row"))

    newest = came.groupBy(key, "_rule").agg(F.max_by(F.struct(*rows.columns), F.struct(time, *order)).alias("_row"))
    newest = newest.filter(F.col("_row")[time].isNotNull())
    until = F.coalesce(F.lead("_rule").over(Window.partitionBy(key).orderBy("_rule")), F.lit(len(found)))
    asked = newest.withColumn("_until", until).filter(F.col("_until") > F.col("_rule"))
    asked = asked.select("_row.*", F.explode(F.sequence(F.col("_rule") + 1, F.col("_until"))).alias("_rule"))
    asked = asked.join(table, "_rule").withColumn("watermark", F.col("_rule_ms") - delay_ms).filter(_holds(found, F.col("_rule")))
    asked = asked.withColumn("asked", F.lit("rule"))
    return own.unionByName(asked.select(*own.columns)).drop("_rule", "_rule_ms")
