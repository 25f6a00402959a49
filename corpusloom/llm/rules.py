"""Quality rules as a ledger of bits: measure and judge every text once, decide later.

``rule_ledger`` scans whole texts once and stores measurements and one bit for every rule that fails. A policy is a
versioned set of rules; applying one, or asking what each of its rules costs, is bitwise work on the stored column
and never reads a text again.

Nulls and empty texts have no words: all measurements 0, the bit of ``few_words`` set. Repeated rows get one
ledger row each. Ratios are compared as products of integers, so nothing is divided by zero.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_batch, texts_of

SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_exclaims",
)

# Rule number (its bit), name and the condition under which a text fails it.
RULES = (
    (0, "few_words", "n_words < 50"),
    (1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    (2, "many_symbols", "10 * n_symbols > n_words"),
    (3, "short_mean_word", "word_chars < 2 * n_words"),
    (4, "long_mean_word", "word_chars > 20 * n_words"),
    (5, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    (6, "shouting", "2 * n_upper > word_chars"),
    (7, "exclaims", "4 * n_exclaims > n_words"),
)

# Versioned policies: the rules that count. Old versions stay, so earlier decisions can be repeated.
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "prose-1": ("few_words", "repeated_windows", "many_symbols", "short_mean_word", "long_mean_word"),
    "prose-2": tuple(name for _, name, _ in RULES),
}


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``."""
    raw = text.encode()
    words = raw.split()  # bytes split at 0x20 and 0x09 to 0x0D
    spaces = sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeats = 0
    if len(seen) < len(windows):
        end = 0
        for i, window in enumerate(windows):
            if seen[window] > 1:
                repeats += i + 3 - max(i, end)
                end = i + 3
    upper = sum(map(raw.count, _UPPER)) if raw.isascii() else sum(map(str.isupper, text))
    return (
        len(words),
        len(text) - spaces,
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        len(lines),
        upper,
        raw.count(b"!"),
    )


_UPPER = [bytes([c]) for c in range(ord("A"), ord("Z") + 1)]


def _measures():
    def step(batch: pa.RecordBatch) -> dict:
        rows = [measure(text) for text in batch.column("text").to_pylist()]
        columns = zip(*rows) if rows else [[] for _ in MEASURES]
        return {"doc_id": batch.column("doc_id")} | {name: list(values) for name, values in zip(MEASURES, columns)}

    return step


def mask(names) -> int:
    """The bits of the rules with these names."""
    bits = {name: bit for bit, name, _ in RULES}
    return sum(1 << bits[name] for name in names)


def rule_ledger(docs: DataFrame) -> DataFrame:
    """One row for every document: ``doc_id``, the measurements and ``fail_bits`` (long)."""
    texts = texts_of(docs)
    id_type = texts.schema["doc_id"].dataType.simpleString()
    measured = by_batch(texts, _measures, f"doc_id {id_type}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = F.lit(0).cast("long")
    for bit, _, condition in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def passes(policy: str, bits: str | Column = "fail_bits") -> Column:
    """True where no rule of the policy failed."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """What every rule of a policy costs: ``rule, n_failed, n_only, kept, kept_without``.

    Documents are first counted by their bits, at most 2 to the number of rules rows, before rules are looked at.
    ``n_only`` counts documents that this rule alone rejects. An empty ledger gives zeros.
    """
    wanted = mask(POLICIES[policy])
    patterns = ledger.groupBy(F.col("fail_bits").bitwiseAND(F.lit(wanted).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    counts = []
    for bit, name, _ in RULES:
        if wanted >> bit & 1:
            one = F.lit(1 << bit).cast("long")
            for label, hit in (("failed", F.col("bits").bitwiseAND(one) != 0), ("only", F.col("bits") == one)):
                counts.append(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias(f"{name}_{label}"))
    kept = F.coalesce(F.sum(F.when(F.col("bits") == 0, F.col("n"))), F.lit(0)).alias("kept")
    rows = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"{name}_failed").alias("n_failed"),
            F.col(f"{name}_only").alias("n_only"),
            F.col("kept"),
            (F.col("kept") + F.col(f"{name}_only")).alias("kept_without"),
        )
        for name in POLICIES[policy]
    ]
    return patterns.agg(kept, *counts).select(F.inline(F.array(*rows)))
