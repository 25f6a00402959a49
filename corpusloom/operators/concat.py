"""Putting datasets one after the other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class SchemaClash(ValueError):
    """Two datasets give one column different types."""


def check_types(dfs: Sequence[DataFrame]) -> None:
    """A union would silently widen number and text columns, so compare the types before it."""
    seen: dict[str, tuple[str, int]] = {}
    for number, df in enumerate(dfs):
        for field in df.schema.fields:
            kind = field.dataType.simpleString()
            first, where = seen.setdefault(field.name, (kind, number))
            if first != kind:
                raise SchemaClash(f"column {field.name}: {first} in dataset {where}, {kind} in dataset {number}")


def concat_datasets(dfs: Sequence[DataFrame], order_column: str | None = "source_ord") -> DataFrame:
    """All rows of all datasets, columns by name, missing ones null. The list order is kept as a column."""
    if not dfs:
        raise ValueError("no datasets to concatenate")
    check_types(dfs)
    if order_column:
        dfs = [df.withColumn(order_column, F.lit(i)) for i, df in enumerate(dfs)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def concat_or_first(
    dfs: Sequence[DataFrame], order_column: str | None = "source_ord", strict: bool = False
) -> tuple[DataFrame, str | None]:
    """The concatenation, or the first dataset alone and the reason why. ``strict`` raises instead."""
    try:
        return concat_datasets(dfs, order_column), None
    except SchemaClash as clash:
        if strict:
            raise
        return concat_datasets(dfs[:1], order_column), str(clash)


def count_by_source(df: DataFrame, column: str = "source") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
