"""Left-to-right folds over one row's array that also put out elements on the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FOLD_WIDTH = 256


def fold_emit(
    items: Column,
    state: Column,
    step: Callable[[Column, Column], tuple[Column, Column]],
    out_type: str,
    width: int = FOLD_WIDTH,
) -> Column:
    """Fold ``items`` and return ``struct(state, out)``.

    ``step(state, item)`` gives the next state (of exactly the same type) and one element to put out, null
    for none. Appending to an array copies it, so the fold works on slices of ``width`` items and appends
    whole slices: the cost stays near linear for arrays of millions of items. No casts inside the fold: a cast
    of an array would copy it at every step.
    """

    def pair(state: Column, out: Column) -> Column:
        return F.struct(state.alias("state"), out.alias("out"))

    none = F.array().cast(f"array<{out_type}>")
    no_slices = F.array().cast(f"array<array<{out_type}>>")

    def push(acc: Column, item: Column) -> Column:
        after, emitted = step(acc["state"], item)
        return pair(after, F.when(emitted.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(emitted))))

    def push_slice(acc: Column, number: Column) -> Column:
        part = F.aggregate(F.slice(items, number * width + 1, F.lit(width)), pair(acc["state"], none), push)
        # transform over a one-element array keeps the inner fold from being evaluated twice
        return F.transform(
            F.array(part), lambda p: pair(p["state"], F.concat(acc["out"], F.array(p["out"])))
        )[0]

    slices = F.sequence(F.lit(0), F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / width).cast("int"))
    return F.aggregate(
        slices, pair(state, no_slices), push_slice, lambda r: pair(r["state"], F.flatten(r["out"]))
    )
