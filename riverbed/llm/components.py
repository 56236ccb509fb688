"""Connected components of a link table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.frames import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of ``links``; root is the least node of its
    component.  Nodes are of any orderable type; null ends are not links.

    Each round takes the least label among a node's neighbours (a partial
    aggregate) and then the label of its label, so the rounds needed grow with
    the logarithm of a component's diameter.  Rounds are written to the shared
    folder: lineage stays short and a lost executor costs only its own tasks.
    No edges: an empty table."""
    one = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null")
    both = materialize(one.union(one.select("v", "u")).filter("u <> v").distinct(), "links")
    label = materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("root")), "labels")
    while True:
        near = (both.join(label.select(F.col("u").alias("v"), "root"), "v")
                .groupBy("u").agg(F.min("root").alias("near")))
        step = label.join(near, "u").select("u", F.col("root").alias("was"), F.least("root", "near").alias("root"))
        jump = label.select(F.col("u").alias("root"), F.col("root").alias("up"))
        step = step.join(jump, "root", "left").select(
            "u", "was", F.least(F.col("root"), F.coalesce("up", "root")).alias("root"))
        step = materialize(step, "labels")
        label = step.select("u", "root")
        if step.filter("was <> root").isEmpty():
            return label.withColumnRenamed("u", "node")
