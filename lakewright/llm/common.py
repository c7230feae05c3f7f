"""Shared pieces of the corpus operators: Arrow batches, byte words, checkpoints."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of text that a Python function sees at once.
SLICE_ROWS = 256
SLICE_BYTES = 8 << 20
#: Bytes of a word: 0-9, a-z and all of a multi-byte character; A-Z become a-z, the rest spaces.
_WORD_TABLE = bytes(
    (b + 32 if 0x41 <= b <= 0x5A else b) if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 text; none of null."""
    return text.translate(_WORD_TABLE).split() if text else []


def word_places(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the words of a text."""
    flat = np.frombuffer(text.translate(_WORD_TABLE), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flat.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column without decoding it."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def hex256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed and kept as files in the checkpoint folder, so that lost executors cost nothing.

    The folder is the cluster's ``spark.checkpoint.dir``. Only where that is unset,
    as in tests on one machine, is a folder chosen here.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def use_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or "/tmp/checkpoints")


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to a new folder in the shared checkpoint folder, and read again."""
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of one key that one task of a join holds; a key of more goes to as many tasks as that asks for.
ROWS_A_TASK = 250_000


def spread_join(rows: DataFrame, values: DataFrame, key: str, salt: F.Column, n: str = "n", per: int | None = None) -> DataFrame:
    """rows with the columns of values, which has one row for each key and, in ``n``, how many rows have it.

    A key of more than ``per`` rows is dealt to several tasks by ``salt``. Such keys, at most a ``per``-th of the rows,
    are what is broadcast.
    """
    per = per or ROWS_A_TASK
    parts = F.ceil(F.col(n) / per).cast("int")
    hot = values.where(F.col(n) > per).select(key, parts.alias("__parts"))
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("__part", F.coalesce(F.pmod(salt, F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    copies = values.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop(n)
    return dealt.join(copies, [key, "__part"]).drop("__part")


def small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it is counted to hold no more than ``rows``; as it is otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """batch in parts of at most SLICE_ROWS rows and SLICE_BYTES of text; a longer text is a part of its own."""
    size = np.zeros(batch.num_rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = min(start + SLICE_ROWS, max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))))
        yield batch.slice(start, stop - start)
        start = stop


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """One output batch for each slice of df's Arrow batches; what fn makes of it is bounded by a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if (out := fn(part)) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def key_crc_mod(key: str, modulus: int) -> F.Column:
    """crc32 of the key as text, modulo; null keys count as the text ''."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus
