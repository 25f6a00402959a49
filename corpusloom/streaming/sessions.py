"""Idle sessions over a stream of activity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.sessions import IDLE_SECONDS

# Later than all data by more than the longest delay.
CLOSING_TIME = "9000-01-01 00:00:00"
WHOLE_BACKLOG = "365000 days"


def stream_idle_sessions(
    events: DataFrame,
    timeout: int = IDLE_SECONDS,
    delay: str = "30 seconds",
    keys: Sequence[str] = ("user_id",),
    ts: str = "ts",
) -> DataFrame:
    """``(keys, first_ts, last_ts, n)`` of every session that has ended.

    A session ends when the watermark (latest time seen less ``delay``) passes its last activity by more than
    the timeout; rows that come later than that are dropped. A gap of exactly the timeout does not end it.

    Over a stored backlog, whose files may come in any order, set ``delay`` longer than all its times span and
    end the input with ``closing_event``: then no row is late, and every session comes out.
    """
    clocked = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    grouped = clocked.groupBy(*keys, F.session_window(ts, f"{timeout} seconds").alias("_window"))
    spans = grouped.agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n"))
    return spans.drop("_window")


def closing_event(events: DataFrame, at: str = CLOSING_TIME, ts: str = "ts") -> DataFrame:
    """The end of an input: one row with null keys, later than all sessions, in the columns of ``events``.

    It closes every session before it and stays open itself, so no session of its own comes out.
    """
    row = events.sparkSession.range(1)
    cols = [F.to_timestamp(F.lit(at)) if f.name == ts else F.lit(None) for f in events.schema.fields]
    return row.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, events.schema.fields)])
