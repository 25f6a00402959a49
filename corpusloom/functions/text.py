"""Scalar text functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.folds import fold_emit

# --- fixed values -------------------------------------------------------------------------------------
# Unicode white space, the characters a plain strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SENTENCE_MARKS = "。！？!?;；"
CJK_FIRST, CJK_LAST = 0x4E00, 0x9FFF
CJK_RANGE = rf"[\x{{{CJK_FIRST:X}}}-\x{{{CJK_LAST:X}}}]"
THINK_OPEN = "<think>"
THINK_CLOSE = "</think>"
# Words, runs of symbols and runs of blanks; a leading space belongs to the word. Lossless.
TOKEN_PATTERN = r" ?\w+| ?[^\w\s]+|\s+"
# A word with its trailing space. Lossless.
CHUNK_PATTERN = r"[^ ]* |[^ ]+"
BYTES_PER_GIB = 1024**3
# ------------------------------------------------------------------------------------------------------


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(value: Column | str) -> Column:
    """Remove white space of any kind on both sides (``trim`` alone removes only the space character)."""
    return F.btrim(col_of(value), F.lit(WHITESPACE))


def normalize_command(value: Column | str) -> Column:
    return F.lower(strip(value))


def is_command(value: Column | str, commands: Sequence[str]) -> Column:
    return F.coalesce(normalize_command(value).isin(*commands), F.lit(False))


def is_blank(value: Column | str) -> Column:
    return F.length(strip(F.coalesce(col_of(value), F.lit("")))) == 0


def prefix(value: Column | str, n: int) -> Column:
    """The first ``n`` code points."""
    return F.substring(col_of(value), 1, n)


def fill_template(template: str, **values: Column | str) -> Column:
    """``"User: {prompt}"`` with the named columns put in. A null value counts as empty text."""
    parts: list[Column] = []
    rest = template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(F.coalesce(col_of(values[name]).cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def detect_lang(value: Column | str, default: str = "en") -> Column:
    """``zh`` when any character lies in the CJK block, else the default; null is the default too."""
    return F.when(col_of(value).rlike(CJK_RANGE), F.lit("zh")).otherwise(F.lit(default))


def _char_class(marks: str) -> str:
    return "".join("\\" + m if m in "\\]^-[&" else m for m in marks)


def _without_blank_tail(value: Column, marks: str) -> Column:
    """A piece with a mark is never blank, so only what follows the last mark can be."""
    text = F.coalesce(value, F.lit(""))
    kept = F.rtrim(text, F.lit(WHITESPACE))
    ends = F.lit(marks).contains(F.right(kept, F.lit(1)))  # true for empty text as well
    return F.when(ends, kept).otherwise(text)


def split_sentences(value: Column | str, marks: str = SENTENCE_MARKS) -> Column:
    """Pieces that end with a mark, in order; the mark stays and blank pieces go."""
    pieces = F.split(_without_blank_tail(col_of(value), marks), f"(?<=[{_char_class(marks)}])")
    return F.array_remove(pieces, "")


def split_and_pack(value: Column | str, limit: int = 100, marks: str = SENTENCE_MARKS) -> Column:
    """``pack_segments(split_sentences(text))`` in one pass of one expression.

    The longest run of whole pieces below the limit is the longest run of fewer than ``limit`` characters
    that ends with a mark or with the text; where there is none, the next piece is a long one.
    """
    if limit < 2:
        return split_sentences(value, marks)
    # Looking back at the mark is several times faster here than matching a class that is not all ASCII.
    ended = rf"(?:(?<=[{_char_class(marks)}])|\z)"
    pattern = rf"(?s).{{1,{limit - 1}}}{ended}|.+?{ended}"
    return F.regexp_extract_all(_without_blank_tail(col_of(value), marks), F.lit(pattern), F.lit(0))


def pack_segments(pieces: Column | str, limit: int = 100) -> Column:
    """Join neighbouring pieces of an array while the result stays below ``limit`` characters.

    A piece that is longer than the limit stays whole. The fold is local to the row.
    """

    def step(held: Column, piece: Column) -> tuple[Column, Column]:
        fits = F.length(held) + F.length(piece) < limit
        flushed = F.when(~fits & (F.length(held) > 0), held)
        return F.when(fits, F.concat(held, piece)).otherwise(piece), flushed

    folded = fold_emit(col_of(pieces), F.lit(""), step, "string")
    return F.transform(
        F.array(folded),
        lambda f: F.when(F.length(f["state"]) > 0, F.concat(f["out"], F.array(f["state"]))).otherwise(f["out"]),
    )[0]


def suffix_of(path: Column | str) -> Column:
    """Lower-cased extension with its dot, empty when the last path element has none."""
    return F.lower(F.regexp_extract(col_of(path), r"(\.[^./]+)$", 1))


def strip_think_text(value: Column | str, open_tag: str = THINK_OPEN, close_tag: str = THINK_CLOSE) -> Column:
    """Replace every marked block by a newline; a block that is never closed hides the rest."""
    closed = F.regexp_replace(col_of(value), F.lit(f"(?s){open_tag}.*?{close_tag}"), F.lit("\n"))
    return F.substring_index(closed, open_tag, 1)


def tokens(value: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(F.coalesce(col_of(value), F.lit("")), F.lit(pattern), F.lit(0))


def count_tokens(value: Column | str, pattern: str = TOKEN_PATTERN) -> Column:
    return F.regexp_count(F.coalesce(col_of(value), F.lit("")), F.lit(pattern))


def to_gib(size: Column | str) -> Column:
    return F.round(col_of(size) / F.lit(BYTES_PER_GIB), 2)


def to_billions(count: Column | str) -> Column:
    return F.round(col_of(count) / F.lit(1e9), 1)


def short_id(key: Column | str) -> Column:
    """Eight hex characters that depend only on the key."""
    return F.substring(F.md5(col_of(key).cast("string")), 1, 8)


def stamp(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), "yyyyMMdd_HHmmss")


def segment_name(session: Column | str, index: Column | str) -> Column:
    return F.format_string("%s_seg%03d", col_of(session), col_of(index))
