"""The bounded training sample of the trained operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on, at most. A documented bound: the rows are those of the smallest
#: hash of their id, the same on every run; all else that the operators do covers every document.
MAX_TRAINING_ROWS = 12_000


def crc_of_key(key: str = "doc_id"):
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, limit: int = MAX_TRAINING_ROWS) -> DataFrame:
    """doc_id, text, label (0 or 1) of at most ``limit`` labelled documents outside the held-out remainder, one row each.

    Null labels and ids take no part; a document labelled more than once is 1 if any label is. Only ids are ranked;
    the chosen ones, at most ``limit``, are what is broadcast to the scan of the texts. Of a doc_id that repeats, the
    text of the smallest hash is taken: repeats are dropped before the shuffle, where they are read.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (crc_of_key() % modulus != held))
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label"))
