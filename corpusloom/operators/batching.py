"""A reproducible order of rows over epochs, and its batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------------
EPOCHS = 3
CPU_BATCH, CPU_ACCUMULATE = 2, 16
# ------------------------------------------------------------------------------------------------------
# A bucket is numbered in one task; more rows than this in the mean take another digit.
BUCKET_ROWS = 1_000_000


def batch_plan(
    df: DataFrame,
    id_column: str,
    epochs: int = EPOCHS,
    per_device: int = CPU_BATCH,
    accumulate: int = CPU_ACCUMULATE,
    seed: int = 42,
    bucket_digits: int | None = None,
) -> DataFrame:
    """``(epoch, rn, micro_batch, step, id)`` with a new, repeatable order in every epoch.

    Rows are ordered by a hash of seed, epoch and id. The first hex digits of the hash are ordered buckets of
    even size; numbering inside the buckets plus the rows of the buckets before gives the global number
    without sorting an epoch in one task. The number of digits follows from the number of rows, so buckets stay
    small; the order does not depend on it. Without epochs there are no rows.
    """
    if bucket_digits is None:
        rows, bucket_digits = df.count(), 1
        while rows > BUCKET_ROWS * 16**bucket_digits:
            bucket_digits += 1
    text = F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"), F.col(id_column).cast("string"))
    rows = (
        df.select(id_column, F.explode(F.slice(F.sequence(F.lit(0), F.lit(max(epochs, 1) - 1)), 1, max(epochs, 0))).alias("epoch"))
        .withColumn("_key", F.md5(text))
        .withColumn("_bucket", F.substring("_key", 1, bucket_digits))
    )
    earlier = Window.partitionBy("epoch").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("epoch", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("epoch", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("epoch", "_bucket").orderBy("_key", id_column))
    numbered = rows.withColumn("_in", inside).join(offsets, ["epoch", "_bucket"])
    rn = F.col("_offset") + F.col("_in") - 1
    return numbered.select("epoch", rn.alias("rn"), id_column).select(
        "epoch",
        "rn",
        F.floor(F.col("rn") / per_device).alias("micro_batch"),
        F.floor(F.col("rn") / (per_device * accumulate)).alias("step"),
        id_column,
    )
