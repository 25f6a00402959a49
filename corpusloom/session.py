"""Session settings the operators rely on, and where shared scratch data goes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that are safe on any cluster: adaptive plans, UTC clocks, Arrow for the few Python operators, room
# for more groups in the hash based collect before it falls back to sorting, and joins that may use a
# partitioning by some of their keys (rows that windows have brought together by conversation stay there).
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g", **extra) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own through spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = os.path.join(tempfile.gettempdir(), f"corpusloom-{spark.sparkContext.applicationId}")
    os.makedirs(folder, exist_ok=True)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; it is never reused, so nothing has to be overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: a stable, restartable cut of the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
