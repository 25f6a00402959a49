"""Array functions for token sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col_of

# --- fixed values -------------------------------------------------------------------------------------
IGNORE_LABEL = -100
CPU_MAX_LENGTH = 512
# ------------------------------------------------------------------------------------------------------


def pad_truncate(ids: Column | str, max_len: int, pad: Column | int, side: str = "right") -> Column:
    """Exactly ``max_len`` ids: the tail is cut, missing places hold ``pad``."""
    pad_value = pad if isinstance(pad, Column) else F.lit(pad)
    head = F.slice(col_of(ids), 1, max_len)
    fill = F.array_repeat(pad_value, F.greatest(F.lit(max_len) - F.size(col_of(ids)), F.lit(0)))
    return F.concat(head, fill) if side == "right" else F.concat(fill, head)


def attention_mask(ids: Column | str, max_len: int, side: str = "right") -> Column:
    """1 for real tokens, 0 for padding. It depends on the length, so a real pad id still counts."""
    n = F.least(F.size(col_of(ids)), F.lit(max_len))
    ones, zeros = F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(max_len) - n)
    return F.concat(ones, zeros) if side == "right" else F.concat(zeros, ones)


def mask_labels(labels: Column | str, pad: Column | int, ignore: int = IGNORE_LABEL) -> Column:
    """Replace the pad id by the id the loss ignores. With pad = eos, true eos ids go as well."""
    pad_value = pad if isinstance(pad, Column) else F.lit(pad)
    return F.transform(col_of(labels), lambda x: F.when(x == pad_value, F.lit(ignore)).otherwise(x))


def last_n(values: Column | str, n: int) -> Column:
    size = F.size(col_of(values))
    return F.slice(col_of(values), F.greatest(size - n + 1, F.lit(1)), n)


def pad_fallback(pad: Column | str, eos: Column | str) -> Column:
    """The pad token, or the end token where there is none."""
    return F.coalesce(col_of(pad), col_of(eos))
