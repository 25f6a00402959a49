"""Lookups in a table whose size is checked first.

A small table becomes one value that every task holds, so looking up arrays of keys is local to the row: no
explode, no join, no shuffle. A bigger one is joined, by broadcast up to a size and by merge beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_INLINE_ROWS = 200_000
MAX_INLINE_BYTES = 16 << 20
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def has_at_most(table: DataFrame, rows: int, size: int) -> bool:
    """Whether the table has at most so many rows and bytes of text; reads no more than ``rows`` + 1 rows.

    The table should be cheap to read, such as a stored one.
    """
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns]
    total = F.coalesce(F.sum(sum(widths[1:], widths[0])), F.lit(0))
    n, held = table.limit(rows + 1).agg(F.count(F.lit(1)), total).first()
    return n <= rows and held <= size


def unique_keys(table: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key, with its smallest value: the rule for keys that come more than once."""
    return table.groupBy(key).agg(F.min(value).alias(value))


def inline_table(table: DataFrame, key: str, value: str, max_rows: int = MAX_INLINE_ROWS) -> Column | None:
    """The table as one array of hash buckets, each a small map; null when it has more rows or bytes than allowed.

    Use it as a column of the table that is looked up from, and ``look_up`` inside ``transform``.
    """
    if not has_at_most(table, max_rows, MAX_INLINE_BYTES):
        return None
    table = unique_keys(table, key, value)
    rows = table.count()
    buckets = 1 << max(rows - 1, 1).bit_length()
    spread = table.select(
        F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int").alias("_bucket"), F.struct(key, value).alias("_entry")
    )
    filled = spread.groupBy("_bucket").agg(F.collect_list("_entry").alias("_entries"))
    every = table.sparkSession.range(buckets).select(F.col("id").cast("int").alias("_bucket"))
    listed = F.sort_array(F.collect_list(F.struct("_bucket", "_entries")))
    maps = F.transform(listed, lambda b: F.map_from_entries(b["_entries"]))
    return every.join(filled, "_bucket", "left").agg(maps.alias("_table")).scalar()


def look_up(table: Column, key: Column) -> Column:
    """The value of a key (of exactly the key type of the table), or null."""
    place = F.pmod(F.xxhash64(key), F.size(table).cast("long")) + 1
    return F.try_element_at(F.element_at(table, place.cast("int")), key)


def lookup(df: DataFrame, table: DataFrame, on: Column, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join. Up to ``max_rows`` rows, and a number of bytes, the table is broadcast. Beyond that both sides are shuffled and
    merged, and the adaptive skew join splits the partitions of frequent keys.
    """
    small = has_at_most(table, max_rows, MAX_BROADCAST_BYTES)
    return df.join(F.broadcast(table) if small else table.hint("merge"), on, "left")
