"""Rules from a table: the best of many needles that stand in a text.

Up to a checked size the needles become one automaton: a trie whose missing arcs lead to the longest suffix that is
again a beginning of a needle, so a text is read once, whatever the number of needles. Every state knows the best rule
that ends in it. Texts are read in pieces that overlap by the longest needle, all pieces of a batch in step, so one
very long text costs no more than many short ones. There is no join and no shuffle; frequent needles and texts
add nothing to a task.

A larger table is joined. Bits of hashes of the needles and of their beginnings, of a bounded size, tell where in a
text a needle may begin and which stretches there may be one; only those are looked up, and the number of the best rule
per row is aggregated before the shuffle. Nothing of the table passes through the driver but those bits and the lengths of
needles. Two different texts with one bit only cost a lookup.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import col_of
from corpusloom.plans.lookup import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, has_at_most
from corpusloom.plans.spread import parts_of
from corpusloom.session import materialize

# Needles of one automaton, and their bytes with their labels. It has at most a state per byte; a state takes 4 bytes for
# each byte value that needles use.
MAX_NEEDLES = 50_000
MAX_NEEDLE_BYTES = 200_000
# Bytes, in the joined form characters, that one piece of a text adds to the ones before it.
PIECE = 512
# Bits for each needle, and each beginning of one, that say whether a text may be it; and at most so many, 8 MB, in all.
BITS_PER_TEXT = 32
MAX_BITS = 1 << 26
# Bytes of text in one task that looks for stretches: its work is some thousand times that of reading them.
TASK_BYTES = 1 << 20
# Pieces that are read in step.
LANES = 65_536
NO_RULE = np.iinfo(np.int64).max


class Automaton:
    """Needles (UTF-8) with the numbers of their rules; the smallest number that occurs in a text is what counts."""

    def __init__(self, needles: Sequence[bytes], numbers: Sequence[int]) -> None:
        self.needles, self.numbers = list(needles), list(numbers)
        self.longest = max(map(len, needles), default=0)

    @cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class of each byte (0: in no needle), next state by state and class, smallest number by state."""
        used = sorted(set(b"".join(self.needles)))
        classes = np.zeros(256, np.int64)
        classes[used] = np.arange(1, len(used) + 1)
        codes = classes.tolist()
        arcs: list[dict[int, int]] = [{}]
        smallest = [NO_RULE]
        for needle, number in zip(self.needles, self.numbers):
            state = 0
            for byte in needle:
                after = arcs[state].setdefault(codes[byte], len(arcs))
                if after == len(arcs):
                    arcs.append({})
                    smallest.append(NO_RULE)
                state = after
            smallest[state] = min(smallest[state], number)
        # Level by level: a state goes on like the state of its longest proper suffix, but for its own arcs.
        step = np.zeros((len(arcs), len(used) + 1), np.int32)
        step[0, list(arcs[0])] = list(arcs[0].values())
        level = [(after, 0) for after in arcs[0].values()]
        while level:
            below = []
            for state, suffix in level:
                smallest[state] = min(smallest[state], smallest[suffix])
                step[state] = step[suffix]
                for code, after in arcs[state].items():
                    below.append((after, int(step[suffix, code])))
                    step[state, code] = after
            level = below
        return classes, step, np.array(smallest, np.int64)

    def __getstate__(self) -> dict:
        return {"needles": self.needles, "numbers": self.numbers, "longest": self.longest}

    def smallest(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The smallest number in each text ``data[start:end]``; ``NO_RULE`` where no needle occurs."""
        found = np.full(len(starts), NO_RULE, np.int64)
        if not self.needles:
            return found
        pieces = -(-(ends - starts) // PIECE)
        text = np.repeat(np.arange(len(starts)), pieces)
        place = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = starts[text] + place * PIECE
        end = np.minimum(first + PIECE, ends[text])
        first = np.maximum(first - (self.longest - 1), starts[text])
        for at in range(0, len(text), LANES):
            some = slice(at, at + LANES)
            np.minimum.at(found, text[some], self._read(data, first[some], end[some]))
        return found

    def _read(self, data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        classes, step, smallest = self.tables
        order = np.argsort(first - end, kind="stable")  # longest first, so those still being read stand in front
        first, left = first[order], (first - end)[order]
        state = np.zeros(len(order), np.int64)
        lowest = np.full(len(order), NO_RULE, np.int64)
        for k in range(-int(left[0])):
            n = int(np.searchsorted(left, -k, side="left"))
            state[:n] = step[state[:n], classes[data[first[:n] + k]]]
            np.minimum(lowest[:n], smallest[state[:n]], out=lowest[:n])
        out = np.empty(len(order), np.int64)
        out[order] = lowest
        return out


def _views(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts and ends of texts; null texts are empty."""
    column = pc.fill_null(pa.array(texts, pa.large_binary(), from_pandas=True), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[: len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets[:-1], offsets[1:]


def usable_rules(rules: DataFrame, needle: str, priority: str, label: str, ignore_case: bool) -> DataFrame:
    """``needle, best``: the best rule of every needle. Empty needles and rules with a null are left out."""
    text = rules[needle].cast("string")
    best = F.struct(rules[priority].cast("long").alias("priority"), rules[label].cast("string").alias("label"))
    rows = rules.select((F.lower(text) if ignore_case else text).alias("needle"), best.alias("best"))
    rows = rows.filter((F.col("needle") != "") & F.col("best.priority").isNotNull() & F.col("best.label").isNotNull())
    return rows.groupBy("needle").agg(F.min("best").alias("best"))


def _by_automaton(df: DataFrame, value: Column, rules: DataFrame, out: str) -> DataFrame:
    rows = rules.collect()
    bests = sorted({(r["best"]["priority"], r["best"]["label"]) for r in rows})
    number = {best: k for k, best in enumerate(bests)}
    automaton = Automaton([r["needle"].encode() for r in rows], [number[tuple(r["best"])] for r in rows])
    held = df.sparkSession.sparkContext.broadcast((automaton, bests))

    @F.pandas_udf("priority bigint, label string")
    def best_of(texts: pd.Series) -> pd.DataFrame:
        automaton, bests = held.value
        found = automaton.smallest(*_views(texts))
        pairs = [bests[k] if k != NO_RULE else (None, None) for k in found.tolist()]
        priorities = pd.array([p for p, _ in pairs], dtype="Int64")
        return pd.DataFrame({"priority": priorities, "label": pd.Series([name for _, name in pairs], dtype=object)})

    found = best_of(value.cast("binary"))
    return df.withColumn(out, found).withColumn(out, F.when(F.col(f"`{out}`.priority").isNotNull(), F.col(f"`{out}`")))


def _bit(text: Column, kind: int, n_bits: int) -> Column:
    """The place of a text among ``n_bits`` (a power of two); ``kind`` keeps beginnings of needles apart from whole ones."""
    return F.xxhash64(text, F.lit(kind)).bitwiseAND(F.lit(n_bits - 1).cast("long"))


def _marked(rules: DataFrame, kinds: Sequence[tuple[Column, int]], n_bits: int) -> Column:
    """Bits by ``_bit`` of a text for every row and kind, 64 to a number, as one array."""
    places = rules.select(F.explode(F.array(*[_bit(text, kind, n_bits) for text, kind in kinds])).alias("bit"))
    word, mask = F.shiftright("bit", 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(63).cast("int"))
    words = places.select(word.alias("id"), mask.alias("mask")).groupBy("id").agg(F.bit_or("mask").alias("mask"))
    every = rules.sparkSession.range(max(n_bits >> 6, 1)).join(words, "id", "left")
    listed = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0)).alias("mask")))).alias("words"))
    return materialize(listed.select(F.transform("words", lambda w: w["mask"]).alias("words")), "rule-bits").scalar()


def _in_order(rules: DataFrame) -> DataFrame:
    """``no, best``: a number for every best rule that sorts like it; sorted in ranges, so no task holds them all."""
    bests = rules.select("best").distinct().orderBy("best.priority", "best.label")
    return materialize(bests.select(F.monotonically_increasing_id().alias("no"), "best"), "rule-order")


def _stretches(rows: DataFrame, rules: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``id, needle``: the stretches of every text that may be needles, once per piece; null where there are none."""
    # needles of similar lengths share a gate, the beginning that is as long as the shortest of them; all pass the first one
    gates: dict[int, list[int]] = {}
    for n in lengths:
        gates.setdefault(min(m for m in lengths if m.bit_length() == n.bit_length()), []).append(n)
    first = lengths[0]
    n_bits = min(1 << (rules.count() * (len(gates) + 1) * BITS_PER_TEXT).bit_length(), MAX_BITS)
    begins = [F.when(F.char_length("needle") >= gate, F.left("needle", F.lit(gate))) for gate in gates]
    bits = _marked(rules, [(F.col("needle"), 0), *zip(begins, gates)], n_bits)

    def found_in(piece: Column, bits: Column) -> Column:
        """Stretches of a piece that may be needles: few others, and all that are."""

        def known(text: Column, kind: int) -> Column:
            bit = _bit(text, kind, n_bits)
            return F.getbit(F.element_at(bits, (F.shiftright(bit, 6) + 1).cast("int")), bit.bitwiseAND(63).cast("int")) == 1

        def cut(places: Column, gate: int, sizes: list[int]) -> Column:
            open_at = places if gate == first else F.filter(places, lambda k: known(F.substring(piece, k, F.lit(gate)), gate))
            return F.flatten(F.transform(open_at, lambda k: F.transform(F.array(*map(F.lit, sizes)), lambda n: F.substring(piece, k, n))))

        begun = F.regexp_extract_all(piece, F.lit(f"(?s)(?=(.{{{first}}}))."), F.lit(1))
        places = F.filter(F.transform(begun, lambda s, k: F.when(known(s, first), k + 1)), lambda k: k.isNotNull())
        cuts = F.transform(F.array(places), lambda places: F.concat(*[cut(places, gate, sizes) for gate, sizes in gates.items()]))
        return F.array_distinct(F.filter(F.flatten(cuts), lambda s: known(s, 0)))

    # pieces with as much text behind them as a needle may have; outer, as Spark tests the input of a plain explode by making it twice
    longest = lengths[-1]
    size = max(PIECE, longest)
    pieces = F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{1,{size + longest - 1}}})).{{1,{size}}}"), F.lit(1))
    texts = rows.select("id", "text")
    # a written table of short texts is one or two splits, however many rows it has
    least = texts.sparkSession.sparkContext.defaultParallelism
    texts = texts.repartition(parts_of(texts, F.octet_length("text"), least, TASK_BYTES), "id")
    held = texts.select("id", F.explode_outer(pieces).alias("piece")).withColumn("_bits", bits)
    # one mention of the bits, so that they are a constant of this step and no column of its rows
    cut = F.flatten(F.transform(F.array("_bits"), lambda bits: found_in(F.col("piece"), bits)))
    return held.select("id", cut.alias("_cut")).select("id", F.explode_outer("_cut").alias("needle"))


def _by_join(df: DataFrame, value: Column, rules: DataFrame, out: str) -> DataFrame:
    lengths = sorted(r[0] for r in rules.select(F.char_length("needle")).distinct().collect())
    kept = [c for c in df.columns if c != out]
    held = [df[c].alias(f"_{k}") for k, c in enumerate(kept)]  # whatever their names
    rows = df.select(F.monotonically_increasing_id().alias("id"), value.alias("text"), *held)
    rows = materialize(rows, "rule-rows")
    if not lengths:
        return rows.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(kept)], F.lit(None).cast(rules.schema["best"].dataType).alias(out))
    order = _in_order(rules)
    numbers = rules.join(order, "best").select("needle", "no")
    small = has_at_most(rules, MAX_BROADCAST_ROWS, MAX_BROADCAST_BYTES)
    hits = _stretches(rows, rules, lengths).join(F.broadcast(numbers) if small else numbers.hint("merge"), "needle")
    best = hits.groupBy("id").agg(F.min("no").alias("no")).join(order, "no").select("id", "best")
    found = rows.join(best, "id", "left")
    return found.select(*[F.col(f"_{k}").alias(c) for k, c in enumerate(kept)], F.col("best").alias(out))


def mark_rules(
    df: DataFrame,
    text: Column | str,
    rules: DataFrame,
    needle: str = "needle",
    priority: str = "priority",
    label: str = "label",
    out: str = "rule",
    ignore_case: bool = True,
    max_needles: int = MAX_NEEDLES,
    max_bytes: int = MAX_NEEDLE_BYTES,
) -> DataFrame:
    """``df`` with ``out``, a struct of ``priority`` and ``label``: the first rule with its needle in the text, or null.

    First is the smallest priority, then the smallest label. Null texts are empty. Empty needles and rules with a null
    match nothing, so an empty table of rules marks nothing; repeated rules count once, repeated rows are marked alike. A
    column ``out`` of ``df`` is replaced, all others are kept. Texts are read whole. ``ignore_case`` lower-cases both
    sides. Up to ``max_needles`` needles of ``max_bytes`` bytes, labels
    included, are an automaton; more are joined, with equal results.
    """
    value = F.coalesce(col_of(text).cast("string"), F.lit(""))
    value = F.lower(value) if ignore_case else value
    usable = materialize(usable_rules(rules, needle, priority, label, ignore_case), "rules")
    small = has_at_most(usable.select("needle", "best.label"), max_needles, max_bytes)
    return (_by_automaton if small else _by_join)(df, value, usable, out)


def classify_by_table(df: DataFrame, text: Column | str, rules: DataFrame, default: str | None = None, out: str = "label", **options) -> DataFrame:
    """``df`` with the label of the first rule of a table (see ``mark_rules``), or ``default``."""
    marked = mark_rules(df, text, rules, out=out, **options)
    return marked.withColumn(out, F.coalesce(F.col(f"`{out}`.label"), F.lit(default).cast("string")))


def classify_listing_by_table(
    names: DataFrame, group: Sequence[str], name: Column | str, rules: DataFrame, default: str | None = None, **options
) -> DataFrame:
    """``group, label``: the first rule that any name of a group reaches; one struct per row goes into the aggregation."""
    marked = mark_rules(names, name, rules, out="_rule", **options)
    best = marked.groupBy(*group).agg(F.min("_rule").alias("_rule"))
    return best.select(*group, F.coalesce(F.col("_rule.label"), F.lit(default).cast("string")).alias("label"))
