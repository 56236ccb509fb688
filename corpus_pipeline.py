"""Training-corpus pipeline over ``documents``: five stages, each over all rows
the one before kept, written as Parquet in the shared folder and read again.

1. language: texts whose language can't be told (no letters, or n-grams far from those
   of every learned language) go;
2. near_duplicates: of each group of near copies (five-word shingles,
   similarity 0.8) the document with the least id stays;
3. secrets: found secrets are masked in the text, no document goes;
4. mix: documents are left out, kept or doubled so that sources reach their
   target weights;
5. tokens: byte-level BPE ids of every copy.

All stages but the last return the columns of their input.  Null, empty, very
long and repeated rows, null ids and sources, empty tables and extra columns
behave as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riverbed.llm import bpe, langid, minhash, mixing, secrets
from riverbed.llm.frames import materialize

VOCABULARY, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, width=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, VOCABULARY, PATTERN, memory=1 << 15).drop("decoded_sha256")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


#: Learned profiles and tokens are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None
