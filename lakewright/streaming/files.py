"""Structured Streaming: folders that files are dropped into, lines and chunks of them, counts with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.index import fixed_chunks
from ..sources.text import decoded, lines


def file_stream(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """file, text, modified of each new file of a folder."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()), T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])
    reader = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", per_trigger)
    return reader.load(path).select(F.col("path").alias("file"), decoded(F.col("content")).alias("text"), F.col("modificationTime").alias("modified"))


def line_stream(files: DataFrame) -> DataFrame:
    return lines(files)


def chunk_stream(files: DataFrame, size: int, overlap: int) -> DataFrame:
    """file, chunk_index, chunk_count, chunk: stateless, so each file counts once by the source's own log."""
    return fixed_chunks(files, "file", "text", size, overlap)


def windowed_counts(events: DataFrame, at: str, key: str, width: str, late: str) -> DataFrame:
    """key, start, n in tumbling windows; rows later than ``late`` are dropped, and state is bounded by it."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("window.start").alias("start"), "n")


def to_parquet(stream: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Starts a query that appends to Parquet, exactly once by its checkpoint; ``once`` takes what is there and stops."""
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()
