"""Text and mail queries: tokens, TF-IDF, mail counts, reply graph, member of the month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.text import STOP_WORDS, email_address, month_of, word_rows, words
from riverbed.plans.oracle_views import with_views
from riverbed.plans.registry import query
from riverbed.session import materialize
from riverbed.sources import views
from riverbed.sources.tables import table

MV = with_views("mails")
_STOPS_SQL = "[" + ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS)) + "]"
D_WORDS = ("list_filter(string_split_regex(lower({t}), '[ \\t\\n\\r\\f]+'), "
           "lambda w: regexp_full_match(w, '[a-z]+') AND NOT list_contains(" + _STOPS_SQL + ", w))")
# fixed values: three automated senders excluded from the mail statistics
BOTS = ["system0@example.org", "system1@example.org", "system2@example.org"]
_BOTS_SQL = ", ".join(f"'{b}'" for b in BOTS)
D_EMAIL = "left(split_part({s}, '<', -1), length(split_part({s}, '<', -1)) - 1)"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of all documents."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


@query("tokenize_words", f"""
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(list_distinct(ws)) AS BIGINT) AS n_distinct
FROM (SELECT doc_id, {D_WORDS.format(t="text")} AS ws FROM documents)""")
def tokenize_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words per document: whitespace tokens, lower case, letters only, no stop words."""
    d = docs(spark, sf_dir).select("doc_id", words("text").alias("ws"))
    return d.select("doc_id", F.size("ws").cast("bigint").alias("n_words"),
                    F.size(F.array_distinct("ws")).cast("bigint").alias("n_distinct"))


def term_frequency_df(d: DataFrame) -> DataFrame:
    """(doc, word, count) — explode then a partial+final count."""
    return word_rows(d, "text", ["doc_id"]).groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("tf"))


def doc_frequency_df(d: DataFrame) -> DataFrame:
    """(word, number of documents containing it) over distinct words per document."""
    return term_frequency_df(d).groupBy("word").agg(F.count(F.lit(1)).alias("df"))


TOKENS_SQL = f"""
WITH toks AS (SELECT doc_id, unnest({D_WORDS.format(t="text")}) AS word FROM documents),
tf AS (SELECT doc_id, word, count(*) AS tf FROM toks GROUP BY ALL),
df AS (SELECT word, count(DISTINCT doc_id) AS df FROM toks GROUP BY word)
"""


@query("term_frequency", TOKENS_SQL + "SELECT * FROM tf")
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return term_frequency_df(docs(spark, sf_dir))


@query("doc_frequency", TOKENS_SQL + "SELECT * FROM df")
def doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doc_frequency_df(docs(spark, sf_dir))


@query("tf_idf", TOKENS_SQL + """
SELECT tf.doc_id, tf.word, round(tf.tf * ((SELECT count(*) FROM documents) / df.df), 6) AS tf_idf
FROM tf JOIN df USING (word)""")
def tf_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF = tf × (N / df) with no logarithm, as the reference computes it.

    N is a scalar sub-query (no eager count on the driver).  TF and DF both
    come from partial aggregates; the join on word lets AQE broadcast DF when
    the vocabulary is small and split hot words when it is not.
    """
    d = docs(spark, sf_dir)
    n = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    # Tokenising is the costly step and the planner does not share it between
    # the two sides of the join, so TF is written once to the shared folder and
    # both sides read it.  Each (doc, word) appears once in TF, so DF is a count
    # over it — a partial aggregate, so a word found in every document is still
    # one row per map task.
    tf = materialize(term_frequency_df(d), "tf")
    j = tf.join(tf.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "word")
    return j.select("doc_id", "word", F.round(F.col("tf") * (n / F.col("df")), 6).alias("tf_idf"))


@query("mail_count", """
SELECT substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS month, o_custkey, count(*) AS cnt FROM orders GROUP BY ALL""")
def mail_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count per (month, sender) — here orders per (month, customer) (A3, F8)."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(month_of(F.col("o_orderdate").cast("string")).alias("month"), "o_custkey").agg(
        F.count(F.lit(1)).alias("cnt"))


@query("extract_month_email", MV + f"""
SELECT message_id, substr(CAST(sent AS VARCHAR), 1, 7) AS month, {D_EMAIL.format(s="sender")} AS email FROM mails""")
def extract_month_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = views.mails(spark, sf_dir)
    return m.select("message_id", month_of(F.col("sent").cast("string")).alias("month"),
                    email_address("sender").alias("email"))


@query("reply_graph", MV + f"""
, m AS (SELECT message_id, reply_to, {D_EMAIL.format(s="sender")} AS email FROM mails)
SELECT r.email AS replier, o.email AS original, count(*) AS cnt
FROM m r JOIN m o ON r.reply_to = o.message_id
WHERE r.email NOT IN ({_BOTS_SQL}) AND o.email NOT IN ({_BOTS_SQL}) GROUP BY ALL""")
def reply_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted reply edges: who answers whom, bots removed (J1, G5, PF8)."""
    m = views.mails(spark, sf_dir).select("message_id", "reply_to", email_address("sender").alias("email"))
    m = m.filter(~F.col("email").isin(BOTS))
    r = m.select(F.col("reply_to").alias("parent"), F.col("email").alias("replier"))
    o = m.select(F.col("message_id").alias("parent"), F.col("email").alias("original"))
    return r.join(o, "parent").groupBy("replier", "original").agg(F.count(F.lit(1)).alias("cnt"))


@query("member_of_month", MV + f"""
, c AS (SELECT substr(CAST(sent AS VARCHAR), 1, 7) AS month, {D_EMAIL.format(s="sender")} AS email, count(*) AS cnt
        FROM mails WHERE {D_EMAIL.format(s="sender")} NOT IN ({_BOTS_SQL}) GROUP BY ALL)
SELECT c.month, c.email, c.cnt FROM c JOIN (SELECT month, max(cnt) AS mx FROM c GROUP BY month) m
  ON c.month = m.month AND c.cnt = m.mx""")
def member_of_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per month the most active sender(s), ties kept (J3, A3, A4, PF8): a count,
    a max of the count, and a join back — all partial aggregates."""
    m = views.mails(spark, sf_dir)
    c = (m.select(month_of(F.col("sent").cast("string")).alias("month"), email_address("sender").alias("email"))
         .filter(~F.col("email").isin(BOTS))
         .groupBy("month", "email").agg(F.count(F.lit(1)).alias("cnt")))
    mx = c.groupBy("month").agg(F.max("cnt").alias("cnt"))
    return c.join(mx, ["month", "cnt"]).select("month", "email", "cnt")
