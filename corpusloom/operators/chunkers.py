"""Texts cut by a user's own chunker, for cuts that no pattern can express."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, Row, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

Chunker = Callable[[str], Iterable[str | None]]


def chunk_with(
    df: DataFrame,
    chunker: Chunker,
    text: str = "text",
    index: str = "chunk_idx",
    content: str = "content",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per chunk that ``chunker`` yields for a text, numbered from 0 in the order they come.

    ``chunker`` takes a text and yields strings one after the other; it runs in the tasks that read the texts, without a
    shuffle, and only one chunk at a time is held beside the text. ``keep`` names the columns that every chunk
    repeats, by default all but the text. A null text has no chunks, an empty one what the chunker makes of it. A null
    chunk is left out and has no number; anything else that is no string ends the query with a ``TypeError``. What the chunker
    raises ends the query too.
    """
    kept = [c for c in df.columns if c != text] if keep is None else list(keep)
    clash = sorted({index, content} & set(kept))
    if clash or index == content:
        raise ValueError(f"names of new columns are taken: {clash or [index]}")
    return chunker_function(chunker, len(kept), index, content)(df.select(*kept, F.col(text).cast("string")).asTable())


def chunker_function(chunker: Chunker, kept: int, index: str = "chunk_idx", content: str = "content"):
    """A table function over rows of ``kept`` columns and a text; its schema follows the table it is given."""

    class Chunks:
        @staticmethod
        def analyze(row: AnalyzeArgument) -> AnalyzeResult:
            schema = StructType(row.dataType.fields[:kept])
            return AnalyzeResult(schema.add(index, IntegerType(), False).add(content, StringType(), False))

        def eval(self, row: Row):
            if row[kept] is None:
                return
            number = 0
            for piece in chunker(row[kept]):
                if piece is None:
                    continue
                if not isinstance(piece, str):
                    raise TypeError(f"a chunk is {type(piece).__name__}, not a string")
                yield (*row[:kept], number, piece)
                number += 1

    return F.udtf(Chunks)
