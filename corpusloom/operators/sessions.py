"""Stretches of activity that end after an idle time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.plans.ordered import sessions_between

# --- fixed values -------------------------------------------------------------------------------------
IDLE_SECONDS = 600
# ------------------------------------------------------------------------------------------------------


def idle_sessions(
    events: DataFrame,
    timeout: float = IDLE_SECONDS,
    keys: Sequence[str] = ("user_id",),
    ts: str = "ts",
    tie: Sequence[str] = ("event_id",),
    name: str = "session",
) -> DataFrame:
    """Number the sessions of every key from 0; a gap of more than ``timeout`` seconds begins a new one."""
    def begins(before: Column, now: Column) -> Column:
        return now.cast("timestamp").cast("double") - before.cast("timestamp").cast("double") > timeout

    return sessions_between(events, keys, (ts, *tie), begins, ts, name)


def session_spans(
    sessions: DataFrame, keys: Sequence[str] = ("user_id",), ts: str = "ts", name: str = "session"
) -> DataFrame:
    return sessions.groupBy(*keys, name).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n")
    )
