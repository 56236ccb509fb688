"""The pipeline's first stage uses what it predicts: letters alone are no language."""

import random

from pyspark.sql import functions as F

import corpus_pipeline


def test_texts_of_no_learned_language_go(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    noise = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyz ", k=300))
    odd = spark.createDataFrame([(10**6, "привет мир как дела"), (10**6 + 1, noise), (10**6 + 2, "12 34")], "doc_id long, text string")
    docs = table.select("doc_id", "text", "lang").unionByName(odd.withColumn("lang", F.lit(None).cast("string")))
    kept = corpus_pipeline.language(spark, docs, str(tmp_path))
    assert kept.filter("doc_id >= 1000000").count() == 0 and kept.count() == table.count()
