"""Which assets are the newest, the stale and the expired ones. Decisions only, nothing is deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import suffix_of

# --- fixed values -------------------------------------------------------------------------------------
KEEP_NEWEST = 10
MAX_AGE_SECONDS = 3600
AUDIO_SUFFIXES = (".wav", ".mp3")
PREVIEW_ROWS = 5
# ------------------------------------------------------------------------------------------------------


def newest(
    files: DataFrame, n: int = KEEP_NEWEST, group: Sequence[str] = (), mtime: str = "modificationTime", tie: str = "path"
) -> DataFrame:
    """The ``n`` newest rows of every group (of the whole table without a group).

    Every task keeps its own ``n`` rows per group before the shuffle, so a large group stays cheap.
    """
    order = [F.desc(mtime), F.asc(tie)]
    if not group:
        return files.orderBy(*order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return files.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def stale(
    files: DataFrame, n: int = KEEP_NEWEST, group: Sequence[str] = (), mtime: str = "modificationTime", tie: str = "path"
) -> DataFrame:
    """Everything ``newest`` does not keep. Group and ``tie`` must identify a row, by them the rows are matched."""
    kept = newest(files.select(*dict.fromkeys([*group, mtime, tie])), n, group, mtime, tie)
    kept = kept.select(*[F.col(c).alias(f"_kept_{i}") for i, c in enumerate([*group, tie])])
    same = F.lit(True)
    for i, c in enumerate([*group, tie]):
        same = same & files[c].eqNullSafe(kept[f"_kept_{i}"])
    return files.join(kept, same, "left_anti").select(*files.columns)


def expired(
    files: DataFrame,
    now: Column,
    suffixes: Sequence[str] = AUDIO_SUFFIXES,
    max_age: float = MAX_AGE_SECONDS,
    path: str = "path",
    mtime: str = "modificationTime",
) -> DataFrame:
    """Files with one of the suffixes that are older than ``max_age`` seconds (exactly that old stays)."""
    age = now.cast("timestamp").cast("double") - F.col(mtime).cast("timestamp").cast("double")
    return files.filter(suffix_of(path).isin(*suffixes) & (age > max_age))


def latest_asset(
    files: DataFrame, group: Sequence[str] = (), path: str = "path", mtime: str = "modificationTime"
) -> DataFrame:
    """Path of the newest file per group; of equal times the greatest path."""
    newest_path = F.max_by(path, F.struct(mtime, path)).alias("latest")
    return files.groupBy(*group).agg(newest_path) if group else files.agg(newest_path)


def first_asset(files: DataFrame, path: str = "path") -> DataFrame:
    return files.orderBy(path).limit(1)


def preview(df: DataFrame, by: str, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows by a column: a top-n, not a sort of the table."""
    return df.orderBy(by).limit(n)
