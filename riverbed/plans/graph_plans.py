"""Weighted graph queries over the nation-to-nation revenue edges: vertices, out
weights, transition probabilities, weighted PageRank, and the TSV edge scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbed.operators.graph import out_weights, pagerank_df, transitions, vertices
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.session import scratch_path
from riverbed.sources import views

EV = with_views("edges")
ITERATIONS = 5
DAMPING = 0.85


@query("graph_vertices", EV + """
SELECT v AS id, 1.0e0 AS value FROM (SELECT src AS v FROM edges UNION SELECT dst FROM edges)""")
def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vertices(views.edges(spark, sf_dir))


@query("graph_out_weight", EV + "SELECT src, round(sum(w), 6) AS out_w FROM edges GROUP BY src")
def graph_out_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out_weights(views.edges(spark, sf_dir)).withColumn("out_w", F.round("out_w", 6))


@query("graph_transition", EV + """
SELECT e.src, e.dst, round(e.w / o.out_w, 9) AS p FROM edges e JOIN (SELECT src, sum(w) AS out_w FROM edges GROUP BY src) o
  ON e.src = o.src""")
def graph_transition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transitions(views.edges(spark, sf_dir)).withColumn("p", F.round("p", 9))


def _pagerank_sql(n_iter: int) -> str:
    steps = [f"""
, v AS (SELECT src AS id FROM edges UNION SELECT dst FROM edges),
n AS (SELECT count(*) AS n FROM v),
t AS (SELECT e.src, e.dst, e.w / o.out_w AS p FROM edges e JOIN (SELECT src, sum(w) AS out_w FROM edges GROUP BY src) o
      ON e.src = o.src),
r0 AS (SELECT id, 1.0e0 AS rank FROM v)"""]
    for i in range(1, n_iter + 1):
        steps.append(f""",
r{i} AS (SELECT v.id, (1 - {DAMPING}e0) / (SELECT n FROM n) + {DAMPING}e0 * coalesce(s.s, 0) AS rank FROM v LEFT JOIN
  (SELECT t.dst, sum(r.rank * t.p) AS s FROM t JOIN r{i - 1} r ON r.id = t.src GROUP BY t.dst) s ON s.dst = v.id)""")
    return EV + "".join(steps) + f"\nSELECT id, round(rank, 9) AS rank FROM r{n_iter}"


@query("pagerank", _pagerank_sql(ITERATIONS))
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted PageRank, damping 0.85, five iterations, ranks start at 1.0."""
    pr = pagerank_df(spark, views.edges(spark, sf_dir), ITERATIONS, DAMPING)
    return pr.select("id", F.round("rank", 9).alias("rank"))


EDGE_SCHEMA = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()),
                            T.StructField("w", T.DoubleType())])


@query("scan_edges_tsv", EV + "SELECT src, dst, round(w, 6) AS w FROM edges")
def scan_edges_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges written as a tab-separated file and read back with an explicit
    schema (IO6, IO16)."""
    path = scratch_path(spark, "edges-tsv")
    views.edges(spark, sf_dir).write.mode("error").option("sep", "\t").csv(path)
    back = spark.read.schema(EDGE_SCHEMA).option("sep", "\t").option("mode", "FAILFAST").csv(path)
    return back.withColumn("w", F.round("w", 6))
