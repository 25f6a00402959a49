"""Long texts as ordered, named segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import (
    col_of,
    segment_name,
    short_id,
    split_and_pack,
    split_sentences,
    stamp,
    strip,
)

# --- fixed values -------------------------------------------------------------------------------------
SEGMENT_LIMIT = 100
# ------------------------------------------------------------------------------------------------------


def sentences(df: DataFrame, text: str = "text", index: str = "piece_no", piece: str = "piece") -> DataFrame:
    """One row per sentence, numbered from 0."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(split_sentences(text)).alias(index, piece))


def segments(df: DataFrame, text: str = "text", limit: int = SEGMENT_LIMIT, index: str = "seg_no") -> DataFrame:
    """One row per packed segment, numbered from 0. Local to each input row: nothing is shuffled."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(split_and_pack(text, limit)).alias(index, text))


def segment_ids(
    df: DataFrame,
    key: str,
    ts: Column | str | None = None,
    text: str = "text",
    limit: int = SEGMENT_LIMIT,
) -> DataFrame:
    """Segments with a session id, a name and, when a time is given, a stamp. Their text is stripped."""
    base = df if ts is None else df.withColumn("stamp", stamp(col_of(ts)))
    session = short_id(key)
    return (
        segments(base, text, limit)
        .withColumn("session", session)
        .withColumn("name", segment_name("session", "seg_no"))
        .withColumn(text, strip(text))
    )
