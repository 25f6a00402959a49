"""What the operators of this package share: Arrow batches in and out, fixed patterns, prefix sums, written tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.session import materialize, scratch_path

__all__ = ["by_batch", "materialize", "prefix_sums", "scratch_path", "settled_crc", "texts_of"]

# Rows of a table of prefix sums that one window task handles.
PREFIX_BLOCK = 4096


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` of a table whatever its other columns are called; a null text is an empty one."""
    return docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def by_batch(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> DataFrame:
    """Map the Arrow batches of every task; ``make`` runs once a task and gives the function for its batches.

    The function returns the columns of ``schema`` by name, as lists or arrays.
    """
    spark = df.sparkSession
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            columns = step(batch)
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def settled_crc(doc_id: Column) -> Column:
    """The crc32 of an id written as text; null ids count as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def prefix_sums(df: DataFrame, order: str, value: str, out: str, block: Column | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows with a smaller ``order``.

    Two levels, so that no task sees more than a block of the table: sums of blocks first, then inside blocks.
    ``block`` must not fall where ``order`` rises; by default it is a long from 0 cut into ranges.
    """
    blocked = df.withColumn("_block", F.expr(f"{order} div {PREFIX_BLOCK}") if block is None else block)
    sums = blocked.groupBy("_block").agg(F.sum(value).alias("_sum"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    blocked = blocked.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return blocked.join(sums, "_block").withColumn(out, F.col("_base") + F.col("_in")).drop("_block", "_base", "_in")
