"""Running aggregates per key that survive a key holding a large share of all rows.

A window over one key is one task. ``with_runs`` counts the rows per key first (only the key columns are
read, and the counts are combined before the shuffle). Its result always has a run number. When no key is too
big that is one constant, marked as such, and every window stays a plain one. Otherwise the rows of the big keys are range-partitioned by key and
order into *runs* of similar size, written once, and carry a run number. ``running`` then works inside
each run and adds what the earlier runs of the key sum up to, a table of at most one row per run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.plans.lookup import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, has_at_most
from corpusloom.session import materialize

RUN = "_run"
WHOLE = -1  # run number of every row whose key was not split
MAX_ROWS_PER_KEY = 1_000_000
# Tasks that the rows of all big keys are dealt over, each of several runs, as long as a task sorts no more than
# ``MAX_ROWS_PER_KEY`` rows; a task costs the driver some kilobytes, a run nothing.
RUN_TASKS = 1_000
# Rows of one task where several ordered steps follow on each other.
PART_ROWS = 250_000
# metadata of the run number: whether any key was split, and how many rows were counted
_SPLIT, _ROWS = "split", "rows"


@dataclass(frozen=True)
class Running:
    kind: str  # sum, max or min
    value: Column
    before: bool = False  # leave the current row out


def total(value: Column, before: bool = False) -> Running:
    return Running("sum", value, before)


def largest(value: Column, before: bool = False) -> Running:
    return Running("max", value, before)


def smallest(value: Column, before: bool = False) -> Running:
    return Running("min", value, before)


_AGGREGATE = {"sum": F.sum, "max": F.max, "min": F.min}


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & left[name].eqNullSafe(right[name])
    return cond


def with_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int = MAX_ROWS_PER_KEY
) -> DataFrame:
    """Add a run number, of more than one value for keys with more than ``max_rows`` rows; see the module text.

    Select the needed columns first: the rows of big keys are written once. ``order`` should tell the rows of
    a key apart. The limit is the same whatever the table holds; the big keys are a written table of any size.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_hot"))
    is_hot = F.col("_hot") > max_rows
    of_hot = [F.sum(F.when(is_hot, x)) for x in (F.ceil(F.col("_hot") / max_rows), F.col("_hot"))]
    runs, total_rows, every_row = counts.agg(*of_hot, F.coalesce(F.sum("_hot"), F.lit(0))).first()
    if not runs:
        return df.select("*", F.lit(WHOLE).cast("long").alias(RUN, metadata={_SPLIT: False, _ROWS: every_row}))
    hot = materialize(counts.filter(is_hot), "hot-keys")
    tasks = min(int(runs) + 1, max(RUN_TASKS, -(-int(total_rows) // MAX_ROWS_PER_KEY)))
    hot = F.broadcast(hot) if has_at_most(hot, MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES) else hot
    marked = df.join(hot, _same(df, hot, keys), "left").select(*[df[c] for c in df.columns], "_hot")
    # sorted rows of a task are numbered one by one, and those of the next task from far beyond
    split = (
        marked.filter(F.col("_hot").isNotNull())
        .drop("_hot")
        .repartitionByRange(tasks, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(RUN, F.floor(F.monotonically_increasing_id() / F.lit(max_rows)))
    )
    # The run numbers are read twice below, so they must not be computed twice.
    split = materialize(split, "runs")
    rest = marked.filter(F.col("_hot").isNull()).drop("_hot").withColumn(RUN, F.lit(WHOLE).cast("long"))
    both = rest.unionByName(split)
    return both.select(*[c for c in both.columns if c != RUN], F.col(RUN).alias(RUN, metadata={_SPLIT: True, _ROWS: every_row}))


def without_runs(df: DataFrame) -> DataFrame:
    return df.drop(RUN)


def is_split(df: DataFrame) -> bool:
    """Whether some key's rows are in several runs."""
    return RUN in df.columns and df.schema[RUN].metadata.get(_SPLIT, True)


def in_parts(df: DataFrame, keys: Sequence[str], rows: int, max_rows: int = PART_ROWS) -> DataFrame:
    """``rows`` rows brought together by key, and by run where keys are split, in parts of at most ``max_rows`` on average.

    The windows of all later steps over the keys stay in these parts, so what a task holds for its sorts does not
    grow with the table, as it would in a fixed number of shuffle partitions.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(-(-rows // max_rows), least), *run_keys(df, keys))


def counted_rows(df: DataFrame) -> int | None:
    """How many rows ``with_runs`` counted; null where it did not."""
    return df.schema[RUN].metadata.get(_ROWS) if RUN in df.columns else None


def run_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [*keys, RUN] if is_split(df) else list(keys)


def ordering(order: Sequence[str], reverse: bool = False) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], reverse: bool = False, **columns: Running
) -> DataFrame:
    """Add running sums, maxima and minima over each key's rows in ``order``."""
    parts = run_keys(df, keys)
    window = Window.partitionBy(*parts).orderBy(*ordering(order, reverse))
    local = [
        _AGGREGATE[spec.kind](spec.value)
        .over(window.rowsBetween(Window.unboundedPreceding, -1 if spec.before else Window.currentRow))
        .alias(name)
        for name, spec in columns.items()
    ]
    out = df.select("*", *local)
    if not is_split(df):
        return _zero_sums(out, columns)

    sums = (
        df.filter(F.col(RUN) != WHOLE)
        .groupBy(*parts)
        .agg(*[_AGGREGATE[spec.kind](spec.value).alias(f"_c_{name}") for name, spec in columns.items()])
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(F.col(RUN).desc() if reverse else F.col(RUN).asc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = sums.select(
        *parts,
        F.count(F.lit(1)).over(earlier).alias("_runs_before"),
        *[_AGGREGATE[spec.kind](F.col(f"_c_{n}")).over(earlier).alias(f"_c_{n}") for n, spec in columns.items()],
    ).filter("_runs_before > 0")  # at most one row per run: only its first key can have begun earlier
    # written, so that later steps over the result don't compute it again
    carry = F.broadcast(materialize(carry, "carry"))
    joined = out.join(carry, _same(out, carry, parts), "left")
    kept = [out[c] for c in df.columns]
    for name, spec in columns.items():
        here, before = out[name], carry[f"_c_{name}"]
        if spec.kind == "sum":
            value = F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        elif spec.kind == "max":
            value = F.greatest(here, before)
        else:
            value = F.least(here, before)
        kept.append(value.alias(name))
    return joined.select(*kept)


@dataclass(frozen=True)
class Mark:
    """The count named ``of`` at the last row where ``flag`` holds: up to a row, before it, or of the whole key."""

    of: str
    flag: Column
    frame: str = "up to"  # up to, before or whole


def composed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    counts: dict[str, Column],
    marks: dict[str, Mark],
    extremes: dict[str, Running] | None = None,
) -> DataFrame:
    """Several running values at once, also such that build on each other: two scans and two shuffles of split rows.

    ``counts`` are running sums of numbers that are not negative, ``marks`` tell a count at the last flagged row,
    ``extremes`` are minima and maxima. What a run of rows does to all of them is one element of a monoid: its sums,
    its extremes, and its marks counted from its begin. Of two runs side by side the sums add up, the better
    extreme stays, and a mark is that of the later run, with the sums of the earlier added, or else that of the
    earlier. So one pass over the rows summarises every run, the summaries of a key are combined on one row per
    run, and a second pass adds to the values inside a run what the runs before it make together.

    The combined summaries hold numbers, not texts: extremes must be of fixed width. They are at most one row per run,
    written once and broadcast.
    """
    extremes = extremes or {}
    parts = run_keys(df, keys)
    ordered = Window.partitionBy(*parts).orderBy(*ordering(order))
    frames = {
        "up to": ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow),
        "before": ordered.rowsBetween(Window.unboundedPreceding, -1),
        "whole": ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing),
    }
    local = df.select(
        "*",
        *[F.coalesce(F.sum(value).over(frames["up to"]), F.lit(0)).alias(name) for name, value in counts.items()],
        *[_AGGREGATE[x.kind](x.value).over(frames["before" if x.before else "up to"]).alias(n) for n, x in extremes.items()],
    )
    at = {name: F.when(mark.flag, F.col(mark.of)) for name, mark in marks.items()}
    local = local.select("*", *[F.max(at[name]).over(frames[mark.frame]).alias(name) for name, mark in marks.items()])
    if not is_split(df):
        return local

    flags = {f"_f_{name}": mark.flag for name, mark in marks.items()}
    values = {f"_v_{name}": value for name, value in counts.items()}
    sizes = {f"_x_{name}": x.value for name, x in extremes.items()}
    needed = df.filter(F.col(RUN) != WHOLE).select(*parts, *order, *[c.alias(n) for n, c in {**flags, **values, **sizes}.items()])
    needed = needed.select("*", *[F.sum(f"_v_{name}").over(frames["up to"]).alias(f"_c_{name}") for name in counts])
    runs = needed.groupBy(*parts).agg(
        *[F.coalesce(F.sum(f"_v_{name}"), F.lit(0)).alias(f"_c_{name}") for name in counts],
        *[F.max(F.when(F.col(f"_f_{name}"), F.col(f"_c_{mark.of}"))).alias(f"_c_{name}") for name, mark in marks.items()],
        *[_AGGREGATE[x.kind](f"_x_{name}").alias(f"_c_{name}") for name, x in extremes.items()],
    )
    by_run = Window.partitionBy(*keys).orderBy(RUN)
    earlier = by_run.rowsBetween(Window.unboundedPreceding, -1)
    every = by_run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = runs.select(
        *parts,
        *[F.coalesce(F.sum(f"_c_{name}").over(earlier), F.lit(0)).alias(f"_b_{name}") for name in counts],
        *[F.col(f"_c_{name}") for name in marks],
        *[_AGGREGATE[x.kind](f"_c_{name}").over(earlier).alias(f"_b_{name}") for name, x in extremes.items()],
    )
    from_start = {name: F.col(f"_c_{name}") + F.col(f"_b_{mark.of}") for name, mark in marks.items()}
    carry = runs.select(
        *parts,
        *[f"_b_{name}" for name in [*counts, *extremes]],
        *[F.max(from_start[n]).over(every if mark.frame == "whole" else earlier).alias(f"_b_{n}") for n, mark in marks.items()],
    )
    carry = F.broadcast(materialize(carry, "carry"))
    joined = local.join(carry, _same(local, carry, parts), "left")
    out = {name: F.coalesce(carry[f"_b_{name}"], F.lit(0)) + local[name] for name in counts}
    for name, mark in marks.items():
        out[name] = F.greatest(local[name] + F.coalesce(carry[f"_b_{mark.of}"], F.lit(0)), carry[f"_b_{name}"])
    for name, x in extremes.items():
        out[name] = (F.least if x.kind == "min" else F.greatest)(local[name], carry[f"_b_{name}"])
    return joined.select(*[local[c] for c in df.columns], *[value.alias(name) for name, value in out.items()])


def sessions_between(df: DataFrame, keys: Sequence[str], order: Sequence[str], begins: Callable[[Column, Column], Column], at: str, name: str) -> DataFrame:
    """Add ``name``: how many rows up to this one begin something new, as ``begins`` tells from ``at`` of the row before and of a row.

    A run's summary is its first and last ``at`` and the begins inside it; between two runs there may be one more.
    """
    parts = run_keys(df, keys)
    ordered = Window.partitionBy(*parts).orderBy(*ordering(order))
    up_to = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def numbered(rows: DataFrame) -> DataFrame:
        new = F.coalesce(begins(F.lag(at).over(ordered), F.col(at)).cast("long"), F.lit(0))
        rows = rows.select("*", new.alias("_new"))
        return rows.select(*[c for c in rows.columns if c != "_new"], F.sum("_new").over(up_to).alias(name))

    local = numbered(df)
    if not is_split(df):
        return local
    runs = numbered(df.filter(F.col(RUN) != WHOLE).select(*parts, *order, *[c for c in [at] if c not in [*parts, *order]]))
    runs = runs.groupBy(*parts).agg(F.max(name).alias("_n"), F.min(F.struct(*order, F.col(at).alias("_at"))).alias("_low"), F.max(F.struct(*order, F.col(at).alias("_at"))).alias("_high"))
    by_run = Window.partitionBy(*keys).orderBy(RUN)
    gap = F.coalesce(begins(F.lag("_high._at").over(by_run), F.col("_low._at")).cast("long"), F.lit(0))
    runs = runs.select(*parts, "_n", gap.alias("_gap"))
    before = F.coalesce(F.sum("_n").over(by_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gaps = F.sum("_gap").over(by_run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = F.broadcast(materialize(runs.select(*parts, (before + gaps).alias("_before")), "carry"))
    joined = local.join(carry, _same(local, carry, parts), "left")
    return joined.select(*[local[c] for c in df.columns], (local[name] + F.coalesce(carry["_before"], F.lit(0))).alias(name))


def _zero_sums(df: DataFrame, columns: dict[str, Running]) -> DataFrame:
    empty_first = {n: F.coalesce(F.col(n), F.lit(0)) for n, s in columns.items() if s.kind == "sum"}
    return df.withColumns(empty_first) if empty_first else df
