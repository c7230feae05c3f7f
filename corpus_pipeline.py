"""A corpus pipeline of five stages: toxicity, near duplicates, benchmark leaks, personal data, tokens.

Each stage works on all that the one before kept. run() writes every stage's result as Parquet in the
cluster's shared folder and reads it again, so a lost executor costs no more than the stage at work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakewright.llm import bpe, decontam, pii, simhash, toxicity
from lakewright.llm.common import written
from lakewright.llm.queries import pseudonym_key


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal values become pseudonyms of their format."""
    return pii.pseudonymize(docs, pseudonym_key(spark))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", pseudonymize),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: A trained model and keyed pseudonyms are beyond SQL.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
