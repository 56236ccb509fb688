"""Graph operators on two DataFrames: vertices(id, value) and edges(src, dst, w)."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.session import materialize


def vertices(edges: DataFrame, initial: float = 1.0) -> DataFrame:
    """Every endpoint once, with the initial value (G1)."""
    ends = edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id")))
    return ends.distinct().select("id", F.lit(initial).alias("value"))


def out_weights(edges: DataFrame) -> DataFrame:
    """Sum of outgoing edge weights per vertex (G2, summing as the Java program does)."""
    return edges.groupBy("src").agg(F.sum("w").alias("out_w"))


def transitions(edges: DataFrame) -> DataFrame:
    """Edge weight ÷ source's total = transition probability."""
    return edges.join(out_weights(edges), "src").select("src", "dst", (F.col("w") / F.col("out_w")).alias("p"))


def pagerank_df(spark: SparkSession, edges: DataFrame, iterations: int, damping: float = 0.85,
                checkpoint_every: int = 2) -> DataFrame:
    """Weighted PageRank: r' = (1−d)/N + d·Σ r(u)·p(u→v); ranks start at 1.0 and
    mass of vertices without out-edges is not redistributed (G4).

    The transition table is hash-partitioned by source once and kept
    (memory and disk), so every iteration's join reuses its partitioning and
    only the rank vector moves.  Ranks are written to the shared checkpoint
    folder every few iterations to cut the lineage; a lost executor then
    recomputes at most ``checkpoint_every`` iterations.
    """
    # the edge list feeds both sides of the transition join; materialise it once
    edges = materialize(edges, "pagerank-edges")
    t = transitions(edges).repartition("src").persist(StorageLevel.MEMORY_AND_DISK)
    v = vertices(t.select("src", "dst")).select("id").persist(StorageLevel.MEMORY_AND_DISK)
    n = v.count()
    ranks = v.select("id", F.lit(1.0).alias("rank"))
    for i in range(1, iterations + 1):
        contrib = (t.join(ranks.withColumnRenamed("id", "src"), "src")
                   .groupBy("dst").agg(F.sum(F.col("rank") * F.col("p")).alias("s")))
        ranks = v.join(contrib.withColumnRenamed("dst", "id"), "id", "left").select(
            "id", ((1 - damping) / n + damping * F.coalesce(F.col("s"), F.lit(0.0))).alias("rank"))
        if i % checkpoint_every == 0 and i < iterations:
            ranks = materialize(ranks, f"pagerank-ranks-{i}")
    return ranks
