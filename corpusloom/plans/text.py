"""Joining the pieces of a text in order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 65_536


_AGGREGATE = {"min": F.min, "max": F.max, "sum": F.sum}


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    index: str,
    value: str,
    name: str,
    bounded: bool = False,
    block_rows: int = BLOCK_ROWS,
    also: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per key with all pieces joined by their integer ``index``.

    Pieces are joined per block of index values first, so no task holds more than ``block_rows`` pieces of a
    key; what is left to join are finished block texts. ``bounded=True`` says that a key is known to have
    fewer pieces than that, which saves the second step. ``also`` maps further columns to
    ``(min | max | sum, column)``, worked out in the same pass.
    """
    also = dict(also or {})
    if not bounded:
        blocks = df.withColumn("_block", F.floor(F.col(index) / F.lit(block_rows)))
        df = _concat(blocks, [*keys, "_block"], index, value, "_part", also)
        index, value, also = "_block", "_part", {n: (kind, n) for n, (kind, _) in also.items()}
    joined = _concat(df, keys, index, value, name, also)
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit("")))


def _concat(
    df: DataFrame, keys: Sequence[str], index: str, value: str, name: str, also: Mapping[str, tuple[str, str]]
) -> DataFrame:
    text = F.expr(f"listagg(`{value}`, '') within group (order by `{index}`)").alias(name)
    return df.groupBy(*keys).agg(text, *[_AGGREGATE[kind](column).alias(n) for n, (kind, column) in also.items()])
