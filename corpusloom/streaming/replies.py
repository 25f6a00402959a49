"""The guards on a reply stream, few values per stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from corpusloom.functions.text import THINK_CLOSE, THINK_OPEN
from corpusloom.operators.chunks import END, MAX_SECONDS, MAX_TOKENS, MIN_CHUNK, REPETITION_WINDOW
from corpusloom.streaming.buckets import BUCKETS, apply_in_buckets
from corpusloom.streaming.timeouts import DELAY

STATE = (
    "next_idx: bigint, seen: bigint, first_at: double, hidden: boolean, held: string, held_start: bigint, recent: array<string>, stopped: boolean,"
    " waiting: array<struct<index: bigint, at: double, content: string, last: boolean>>"
)
FRESH = (0, 0, None, False, "", None, [], False, [])


def stream_reply_filter(
    chunks: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_seconds: float = MAX_SECONDS,
    window: int = REPETITION_WINDOW,
    min_len: int = MIN_CHUNK,
    open_tag: str = THINK_OPEN,
    close_tag: str = THINK_CLOSE,
    end: str = END,
    idle_ms: int | None = None,
    ts: str | None = None,
    delay: str = DELAY,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming form of the batch reply filter.

    Input ``(stream_id, chunk_idx, at, content, is_last)``: indexes run from 0 without gaps, ``at`` is the
    arrival in seconds (null for no clock), ``is_last`` marks the final chunk. Chunks that arrive ahead of a
    missing one wait for it. What a stream holds back comes out with its last chunk. The state holds at most
    ``window`` pieces besides the waiting chunks.

    With ``ts``, the column of event times, a stream ends when the watermark (the latest time seen less ``delay``)
    passes its latest chunk by ``idle_ms``: what waits behind a gap then comes out in order, and its state goes. No
    clock is involved, so a run over what is there now gives the same rows each time; ``drain`` with an
    ``end_of_input`` ends all streams. Chunks older than the watermark are late and left out.

    The streams share ``buckets`` states (see ``apply_in_buckets``).

    Without ``ts``, ``idle_ms`` is time on the clock without input. Set it for a query that
    runs all the time; a run over what is there now would wait for such timeouts without end.
    """
    half = window // 2
    out_schema = T.StructType([T.StructField("chunk_idx", T.LongType()), T.StructField("content", T.StringType())])

    def step(key: str | None, values: tuple | None, rows: list[tuple], ended: bool) -> tuple[list[tuple], tuple | None]:
        next_idx, seen, first_at, hidden, held, start, recent, stopped, ahead = values or FRESH
        recent = list(recent)
        waiting = {row[0]: tuple(row) for row in ahead}
        out: list[tuple[int, str]] = []

        def emit(index: int, piece: str) -> bool:
            """Put the piece out; false when it repeats what came before or is the sentinel."""
            recent.append(piece)
            del recent[:-window]
            if len(recent) == window:
                newer = "".join(recent[half:])
                if newer and newer == "".join(recent[:half]):
                    return False
            if piece == end:
                return False
            out.append((index, piece))
            return True

        def put_rest() -> None:
            """What is held at the end of a stream comes out untested."""
            if held and held != end:
                out.append((start, held))

        def advance() -> None:
            """Take the waiting chunk that is next."""
            nonlocal next_idx, seen, first_at, hidden, held, start, stopped
            index, at, content, last = waiting.pop(next_idx)
            next_idx += 1
            seen += 1
            first_at = at if seen == 1 else first_at
            late = at is not None and first_at is not None and at - first_at > max_seconds
            over = late or seen > max_tokens
            if not over:
                content = content or ""
                if open_tag in content:
                    hidden, content = True, ""
                elif close_tag in content:
                    hidden, content = False, "\n"
                elif hidden:
                    content = ""
                if content:
                    start = index if not held else start
                    held += content
                    if len(held) >= min_len:
                        stopped, held = not emit(start, held), ""
            if (over or last) and not stopped:
                if not over:
                    put_rest()
                stopped, held = True, ""

        if ended:
            # no more input: what waits behind a gap comes out in order, then the rest
            while waiting and not stopped:
                next_idx = min(waiting)
                advance()
            if not stopped:
                put_rest()
            return out, None
        for index, at, content, last in rows:
            if not pd.isna(index) and index >= next_idx and not stopped:
                waiting[int(index)] = (int(index), None if pd.isna(at) else float(at), content, bool(last))
        while not stopped and next_idx in waiting:
            advance()
        if key is None and not waiting and not seen:
            return out, None  # the end of the input, which is no stream
        if stopped:
            recent, waiting = [], {}
        rest = [waiting[index] for index in sorted(waiting)]
        return out, (next_idx, seen, first_at, hidden, held, start, recent, stopped, rest)

    columns = ["chunk_idx", "at", "content", "is_last"]
    return apply_in_buckets(chunks, "stream_id", columns, step, out_schema, STATE, idle_ms, ts, delay, buckets)
