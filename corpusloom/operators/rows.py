"""User functions over rows and batches, and mappings with a fallback."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _merged_schema(base: T.StructType, returned: T.StructType, drop: Sequence[str] = ()) -> T.StructType:
    replaced = {f.name: f for f in returned.fields}
    kept = [replaced.pop(f.name, f) for f in base.fields if f.name not in drop or f.name in replaced]
    return T.StructType(kept + [f for f in returned.fields if f.name in replaced])


def _struct(df: DataFrame, schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def map_rows(df: DataFrame, fn: Callable[[dict[str, Any]], dict[str, Any]], schema: str | T.StructType) -> DataFrame:
    """Call ``fn`` with every row as a dict and merge what it returns over the row.

    ``schema`` names the returned columns. Rows travel in Arrow batches; use expressions where they suffice.
    """
    out = _merged_schema(df.schema, _struct(df, schema))
    names = out.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            rows = [{**row, **fn(row)} for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in rows], schema=arrow)

    return df.mapInArrow(run, out)


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str | T.StructType,
    remove: Sequence[str] = (),
) -> DataFrame:
    """Call ``fn`` with every batch; its columns are merged over the batch, those in ``remove`` go."""
    out = _merged_schema(df.schema, _struct(df, schema), remove)
    names = out.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            returned = fn(batch)
            kept = batch[[c for c in names if c in batch.columns and c not in returned.columns]]
            yield pd.concat([kept.reset_index(drop=True), returned.reset_index(drop=True)], axis=1)[names]

    return df.mapInPandas(run, out)


def with_fallback(
    df: DataFrame,
    primary: Callable[[DataFrame], DataFrame],
    secondary: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """``primary``, or ``secondary`` for the whole table when ``primary`` cannot be planned."""
    try:
        planned = primary(df)
        planned.schema  # analysis happens here at the latest
        return planned
    except (AnalysisException, ValueError):
        return secondary(df)


def value_or(attempt: Column, fallback: Column) -> Column:
    """For errors in the data: a ``try_*`` expression, and another one for the rows where it fails."""
    return F.coalesce(attempt, fallback)
