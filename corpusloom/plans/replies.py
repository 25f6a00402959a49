"""The guards on a reply stream as one plan over chunk tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.chunks import (
    END,
    INDEX,
    MAX_SECONDS,
    MAX_TOKENS,
    MIN_CHUNK,
    REPETITION_WINDOW,
    STREAM,
    mark_budget,
    rechunk,
    repetition_guard,
    suppress_think,
    take_until_sentinel,
)
from corpusloom.functions.text import THINK_CLOSE, THINK_OPEN
from corpusloom.plans.ordered import MAX_ROWS_PER_KEY, PART_ROWS, counted_rows, in_parts, is_split, largest, running, with_runs, without_runs
from corpusloom.plans.text import BLOCK_ROWS


def filter_replies(
    chunks: DataFrame,
    max_tokens: int = MAX_TOKENS,
    max_seconds: float = MAX_SECONDS,
    window: int = REPETITION_WINDOW,
    min_len: int = MIN_CHUNK,
    open_tag: str = THINK_OPEN,
    close_tag: str = THINK_CLOSE,
    end: str = END,
    keys: Sequence[str] = STREAM,
    index: str = "chunk_idx",
    content: str = "content",
    ts: str | None = None,
    split_above: int | None = MAX_ROWS_PER_KEY,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Budget, hidden blocks, chunk size, repetition, sentinel: in this order.

    The budget counts all chunks, the repetition guard sees only the re-chunked text. What a stream holds back at
    its end comes out untested; a stream that the budget stops has no such rest. A budget of up to ``BLOCK_ROWS``
    chunks makes every stream small, so what follows needs no further splitting. ``split_above`` is
    the number of chunks from which one stream is worked on in parts; null leaves out the count that finds
    such streams, and that of all chunks, by which tasks get at most ``part_rows`` of them on average.
    """
    if split_above is not None:
        chunks = with_runs(chunks, keys, (index,), split_above)
    rows, split = counted_rows(chunks), is_split(chunks)
    chunks = in_parts(chunks, keys, rows, part_rows) if rows is not None else chunks
    marked = mark_budget(chunks, max_tokens, max_seconds, keys, (index,), ts)
    over = F.col("stop_reason").isNotNull().cast("int")
    marked = running(marked, keys, (index,), reverse=True, _cut=largest(over))  # 1 on every chunk of a stopped stream
    within = marked.filter("stop_reason IS NULL").drop("stop_reason")
    small = max_tokens <= BLOCK_ROWS  # then every stream is small from here on
    within = without_runs(within) if small else within
    within = in_parts(within, keys, rows, part_rows) if rows is not None and split and small else within  # by key now, not by run
    shown = suppress_think(within, open_tag, close_tag, keys, (index,), content)
    pieces = rechunk(shown, min_len, keys, index, content, bounded=small, cut="_cut")
    if not small and split_above is not None:
        pieces = with_runs(pieces, keys, (index,), split_above)
        pieces = in_parts(pieces, keys, counted_rows(pieces) or 0, part_rows)
    fresh = repetition_guard(pieces, window, keys, (index,), content, exempt=F.length(content) < min_len)
    return without_runs(take_until_sentinel(fresh, end, keys, (index,), content))
