"""Session defaults shared by tests, the bench and the registry."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session with the defaults; keyword names use ``__`` for dots."""
    conf = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.driver.memory": memory,
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
    }
    conf |= {k.replace("__", "."): v for k, v in extra.items()}
    spark = SparkSession.builder.master(f"local[{cores}]").appName("lakewright").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """A table of so few splits that cores would idle, dealt evenly; any larger one as it is, without a shuffle.

    For work that is heavy for its bytes: a small file of one row group is one task otherwise.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() <= 2 * cores else df
