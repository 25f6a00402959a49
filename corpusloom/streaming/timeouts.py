"""When a keyed state ends: by event time and a watermark, or by the clock."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

DELAY = "1 day"
# The time of rows of a stored table that has none; none of them is ever late before the end of the input.
NO_TIME = "2000-01-01 00:00:00"
# Later than all data, and the last year that pandas can tell.
END_TIME = "2262-01-01 00:00:00"


def timeout_kind(idle_ms: int | None, ts: str | None) -> str:
    if ts is not None:
        return GroupStateTimeout.EventTimeTimeout
    return GroupStateTimeout.NoTimeout if idle_ms is None else GroupStateTimeout.ProcessingTimeTimeout


def times_ms(times: pd.Series) -> list[int]:
    """Event times in milliseconds; rows without a time count as the earliest."""
    return times.to_numpy().astype("datetime64[ms]").astype("int64").clip(0).tolist()


def without_times(df: DataFrame, ts: str) -> DataFrame:
    """A stored table or stream that has no times, with one time for all rows."""
    return df.withColumn(ts, F.to_timestamp(F.lit(NO_TIME)))


def end_of_input(df: DataFrame, ts: str, at: str = END_TIME) -> DataFrame:
    """The end of a whole input: one row without a key, later than all others by more than any delay, in the columns of ``df``."""
    cols = [F.to_timestamp(F.lit(at)) if f.name == ts else F.lit(None) for f in df.schema.fields]
    return df.sparkSession.range(1).select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, df.schema.fields)])
