"""Using all cores on an input that comes in few splits, and parts of a bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A scan of so few splits holds no more than that many times ``spark.sql.files.maxPartitionBytes``.
MAX_SPLITS = 16
# Rows of one part that is grouped by row again (a task sorts more groups than ``SETTINGS`` allows), and bytes of their texts.
PART_ROWS = 2_000
PART_BYTES = 8 << 20


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan of at most ``MAX_SPLITS`` splits over the session's cores.

    For work that costs much more than moving its input, such as long regular expressions over one small file
    with a single row group. What is moved is bounded by the splits; any larger table is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    splits = df.rdd.getNumPartitions()
    return df.repartition(cores) if splits <= min(MAX_SPLITS, cores - 1) else df


def parts_of(df: DataFrame, size: Column, least: int, max_bytes: int = PART_BYTES, max_rows: int | None = None) -> int:
    """How many parts the rows make of at most ``max_bytes``, as ``size`` tells them, and ``max_rows`` on average."""
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return max(-(-n // max_rows) if max_rows else 1, -(-total // max_bytes), least)


def dealt(df: DataFrame, key: str, size: Column) -> DataFrame:
    """Rows dealt out by a key that tells them apart, in parts of a bounded number of rows and sum of sizes.

    What is exploded, looked up in a broadcast table and grouped by the key again then stays in its task: the rows
    are shuffled once, before they are exploded, and a task has few enough groups to hold them without sorting.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parts_of(df, size, least, PART_BYTES, PART_ROWS), key)
