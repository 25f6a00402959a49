"""Listings of files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------------
IMAGE_SUFFIXES = (".jpg", ".jpeg", ".png", ".webp")
# ------------------------------------------------------------------------------------------------------


def list_assets(spark: SparkSession, folder: str, suffixes: Sequence[str] = IMAGE_SUFFIXES) -> DataFrame:
    """``(path, modificationTime, length)`` of the files in one folder with one of the suffixes, any case.

    File contents are never read: the content column is pruned from the scan.
    """
    pattern = "(?i)(" + "|".join(re.escape(s) for s in suffixes) + ")$"
    files = spark.read.format("binaryFile").load(folder)
    return files.select("path", "modificationTime", "length").filter(F.col("path").rlike(pattern))
