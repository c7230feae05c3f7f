"""Cutting lineage with files that every executor can read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Takes the cluster's checkpoint folder; one is chosen here only where none is set, as in tests."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir") or "/tmp/checkpoints")


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed and kept in the checkpoint folder."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
