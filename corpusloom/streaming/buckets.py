"""Keyed state held in a fixed number of buckets of keys.

A call of a stateful Python function costs some milliseconds, whatever it does, and every key is called when it has
rows and again when it ends. So a state holds the keys of one bucket, by hash: a trigger makes at most as many calls
as there are buckets, and what is left per key are its rows. Each key still begins, advances and ends on its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState

from corpusloom.streaming.timeouts import DELAY, times_ms, timeout_kind

# States of one stream; a state is rewritten when one of its keys has rows, so more of them suit many live keys.
BUCKETS = 16_384
# Of a key: its values, its rows as tuples of the columns, whether it has ended. Gives rows out and its values, none when they go.
Step = Callable[[str | None, tuple | None, list[tuple], bool], tuple[list[tuple], tuple | None]]


def apply_in_buckets(
    rows: DataFrame,
    key: str,
    columns: Sequence[str],
    step: Step,
    out: T.StructType,
    values: str,
    idle_ms: int | None = None,
    ts: str | None = None,
    delay: str = DELAY,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``key`` and ``out``: what ``step`` puts out for the rows of every key, with its values as state between triggers.

    A key ends ``idle_ms`` after its latest row: by event time and the watermark with ``ts``, else by the clock, and
    never without either. It is then called once more, without rows. The key is of an atomic type.
    """
    kind = rows.schema[key].dataType
    state_schema = f"keys array<struct<_key: string, _latest: bigint, {values}>>"
    out_schema = T.StructType([T.StructField("_key", T.StringType()), *out.fields])
    names = out_schema.names

    def run(_: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {entry[0]: tuple(entry) for entry in (state.get[0] if state.exists else ())}
        now = state.getCurrentWatermarkMs() if ts is not None else state.getCurrentProcessingTimeMs()
        touched = set()
        for batch in () if state.hasTimedOut else batches:
            times = times_ms(batch[ts]) if ts is not None else [now] * len(batch)
            by_key: dict[str | None, tuple[list[tuple], list[int]]] = {}
            for name, time, *row in zip(batch["_key"].tolist(), times, *[batch[c].tolist() for c in columns]):
                some, at = by_key.setdefault(None if pd.isna(name) else name, ([], []))
                some.append(row)
                at.append(time)
            put = []
            for name, (some, at) in by_key.items():
                before = held.pop(name, None)
                found, after = step(name, before and before[2:], some, False)
                put += [(name, *row) for row in found]
                if after is not None:
                    held[name] = (name, max(before[1] if before else 0, *at), *after)
            touched.update(by_key)
            if put:
                yield pd.DataFrame(dict(zip(names, zip(*put))), dtype=object)
        if ts is not None or idle_ms is not None:
            wait = idle_ms or 0
            # as Spark does it: a time is over when it stands before the watermark, and not for keys that have rows now
            over = [name for name, entry in held.items() if name not in touched and (entry[1] + wait + 1 < now if ts is not None else entry[1] + wait <= now)]
            put = [(name, *row) for name in over for row in step(name, held.pop(name)[2:], [], True)[0]]
            if put:
                yield pd.DataFrame(dict(zip(names, zip(*put))), dtype=object)
        if not held:
            if state.exists:
                state.remove()
            return
        state.update((list(held.values()),))
        if ts is not None:
            state.setTimeoutTimestamp(max(min(entry[1] for entry in held.values()) + wait, now) + 1)
        elif idle_ms is not None:
            state.setTimeoutDuration(max(min(entry[1] for entry in held.values()) + wait - now, 1))

    timed = rows if ts is None else rows.withWatermark(ts, delay)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")
    needed = timed.select(bucket, F.col(key).cast("string").alias("_key"), *columns, *[c for c in [ts] if c is not None])
    found = needed.groupBy("_bucket").applyInPandasWithState(run, out_schema, state_schema, "append", timeout_kind(idle_ms, ts))
    return found.select(F.col("_key").cast(kind).alias(key), *out.names)
