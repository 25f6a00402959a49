"""Rules over the names in a group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.rules import DEFAULT_FAMILY, LISTING_RULES, PACKED_FAMILY, PACKED_SUFFIXES, is_packed
from corpusloom.functions.text import col_of


def classify_names(
    names: Column | str,
    rules: Sequence[tuple[Sequence[str], str]] = LISTING_RULES,
    default: str = DEFAULT_FAMILY,
    packed: Sequence[str] = PACKED_SUFFIXES,
) -> Column:
    """Label of the first rule that any element of an array of names satisfies; a packed suffix goes first."""
    lowered = F.transform(F.coalesce(col_of(names), F.array().cast("array<string>")), F.lower)
    label = F.lit(default)
    for needles, name in reversed(rules):
        label = F.when(F.exists(lowered, _has_any(needles)), name).otherwise(label)
    return F.when(F.exists(lowered, lambda n: is_packed(n, packed)), PACKED_FAMILY).otherwise(label) if packed else label


def _has_any(needles: Sequence[str]) -> Callable[[Column], Column]:
    def test(text: Column) -> Column:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | text.contains(needle)
        return hit

    return test


def classify_listing(
    names: DataFrame,
    group: Sequence[str],
    name: str,
    rules: Sequence[tuple[Sequence[str], str]] = LISTING_RULES,
    default: str = DEFAULT_FAMILY,
    packed: Sequence[str] = PACKED_SUFFIXES,
) -> DataFrame:
    """The same for one name per row: the lowest rule number that any name of the group reaches.

    Each row is reduced to a number first, so a group of any size is combined before the shuffle.
    """
    low = F.lower(F.coalesce(F.col(name), F.lit("")))
    number = F.lit(len(rules))
    for i in range(len(rules) - 1, -1, -1):
        number = F.when(_has_any(rules[i][0])(low), F.lit(i)).otherwise(number)
    if packed:
        number = F.when(is_packed(low, packed), F.lit(-1)).otherwise(number)
    best = names.groupBy(*group).agg(F.min(number).alias("_rule"))
    label = F.when(F.col("_rule") == -1, PACKED_FAMILY).otherwise(F.lit(default))
    for i, (_, value) in enumerate(rules):
        label = F.when(F.col("_rule") == i, value).otherwise(label)
    return best.select(*group, label.alias("label"))
