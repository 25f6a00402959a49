"""Vocabulary, encoding and decoding as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.arrays import attention_mask, mask_labels, pad_fallback, pad_truncate
from corpusloom.functions.text import TOKEN_PATTERN, tokens
from corpusloom.plans.lookup import MAX_INLINE_ROWS, inline_table, look_up, lookup, unique_keys
from corpusloom.plans.spread import dealt
from corpusloom.session import materialize

PAD, EOS, UNK = "<pad>", "</s>", "<unk>"
SPECIALS = (PAD, EOS, UNK)


def build_vocab(
    df: DataFrame,
    size: int,
    specials: Sequence[str] = SPECIALS,
    text: str = "text",
    pattern: str = TOKEN_PATTERN,
) -> DataFrame:
    """``(token, token_id, is_special, n)``: the special tokens, then the ``size`` most frequent ones.

    Counts are combined before the shuffle and the top rows are taken per task first; only those ``size``
    rows are ever numbered in one place.
    """
    counts = df.select(F.explode(tokens(text, pattern)).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    if specials:
        counts = counts.filter(~F.col("token").isin(*specials))
    top = counts.orderBy(F.desc("n"), "token").limit(size)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "token"))
    regular = top.select(
        "token", (rank + len(specials) - 1).alias("token_id"), F.lit(False).alias("is_special"), "n"
    )
    if not specials:
        return regular
    fixed = df.sparkSession.createDataFrame(
        [(t, i, True, 0) for i, t in enumerate(specials)], "token string, token_id int, is_special boolean, n bigint"
    )
    return fixed.unionByName(regular)


def special_tokens(vocab: DataFrame) -> DataFrame:
    return vocab.filter("is_special").select("token", "token_id")


def with_pad(special: DataFrame, pad: str = "pad_token", eos: str = "eos_token") -> DataFrame:
    """Set the pad token to the end token where it is missing."""
    return special.withColumn(pad, pad_fallback(pad, eos))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    max_len: int | None,
    unk_id: int,
    keys: Sequence[str] = ("doc_id",),
    text: str = "text",
    pattern: str = TOKEN_PATTERN,
    max_inline: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """``(keys, input_ids)`` of every row: ids of the first ``max_len`` tokens, of all without a limit.

    An empty text has no ids; of a token that the vocabulary holds twice the smallest id counts. Tokens past the
    limit are cut before the lookup. With a vocabulary of up to ``max_inline`` tokens the work is local to each
    row. Beyond that rows are numbered and written once, dealt out by number, and their tokens are joined with it;
    the rows are the same either way. ``vocab`` should be a stored table.
    """
    cut = tokens(text, pattern)
    cut = cut if max_len is None else F.slice(cut, 1, max_len)
    table = inline_table(vocab, "token", "token_id", max_inline)
    if table is not None:
        held = df.select(*keys, text, table.alias("_table"))
        ids = F.transform(cut, lambda t: F.coalesce(look_up(F.col("_table"), t), F.lit(unk_id)))
        return held.select(*keys, ids.alias("input_ids"))
    rows = _numbered(df.select(*keys, F.col(text).alias("_text")), "encode")
    cut = tokens("_text", pattern)
    cut = cut if max_len is None else F.slice(cut, 1, max_len)
    # outer, as Spark tests the input of a plain explode by making it twice
    long = dealt(rows, "_row", F.octet_length("_text")).select("_row", F.posexplode_outer(cut).alias("_pos", "_token")).filter("_pos IS NOT NULL")
    words = unique_keys(vocab, "token", "token_id").select(F.col("token").alias("_vocab_token"), F.col("token_id").alias("_id"))
    found = lookup(long, words, F.col("_token") == F.col("_vocab_token"))
    known = F.coalesce("_id", F.lit(unk_id))
    if isinstance(vocab.schema["token_id"].dataType, T.IntegerType) and -(1 << 31) <= unk_id < 1 << 31:  # place and id in one number, a quarter of a struct
        pair = F.shiftleft(F.col("_pos").cast("long"), 32).bitwiseOR(known.cast("long").bitwiseAND(0xFFFFFFFF))
        ids = F.transform("_pairs", lambda p: _low_int(p))
    else:
        pair = F.struct("_pos", known.alias("_id"))
        ids = F.transform("_pairs", lambda p: p["_id"])
    listed = found.groupBy("_row").agg(F.sort_array(F.collect_list(pair)).alias("_pairs")).select("_row", ids.alias("_ids"))
    return rows.select("_row", *keys).join(listed, "_row", "left").select(*keys, F.coalesce("_ids", F.array().cast("array<int>")).alias("input_ids"))


def _low_int(pair: Column) -> Column:
    """The low 32 bits of a number as a signed one."""
    low = pair.bitwiseAND(0xFFFFFFFF)
    return (low - F.when(low > 0x7FFFFFFF, F.lit(1 << 32)).otherwise(F.lit(0).cast("long"))).cast("int")


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number for every row, written once so that the numbers stay."""
    return materialize(df.withColumn("_row", F.monotonically_increasing_id()), name)


def training_arrays(encoded: DataFrame, max_len: int, pad_id: int, ids: str = "input_ids") -> DataFrame:
    """Padded ``input_ids``, ``attention_mask`` and ``labels`` (a copy with padding masked)."""
    padded = encoded.withColumn("attention_mask", attention_mask(ids, max_len)).withColumn(
        ids, pad_truncate(ids, max_len, pad_id)
    )
    return copy_labels(padded, ids).withColumn("labels", mask_labels("labels", pad_id))


def copy_labels(df: DataFrame, ids: str = "input_ids") -> DataFrame:
    return df.withColumn("labels", F.col(ids))


def decode(
    df: DataFrame,
    vocab: DataFrame,
    keys: Sequence[str] = ("doc_id",),
    ids: str = "input_ids",
    skip_special: bool = True,
    max_inline: int = MAX_INLINE_ROWS,
) -> DataFrame:
    """``(keys, text)`` of every row: tokens of the ids joined again; special tokens are dropped.

    Sizes as in ``encode``; of an id that the vocabulary holds twice the smallest token counts.
    """
    shown = vocab.filter(~F.col("is_special")) if skip_special else vocab
    words = shown.select("token_id", "token")
    table = inline_table(words, "token_id", "token", max_inline)
    if table is not None:
        kind = vocab.schema["token_id"].dataType
        held = df.select(*keys, ids, table.alias("_table"))
        found = F.transform(ids, lambda i: look_up(F.col("_table"), i.cast(kind)))
        return held.select(*keys, F.coalesce(F.array_join(found, ""), F.lit("")).alias("text"))
    rows = _numbered(df.select(*keys, F.col(ids).alias("_ids")), "decode")
    long = dealt(rows, "_row", F.size("_ids").cast("long") * 8).select("_row", F.posexplode_outer("_ids").alias("_pos", "_id")).filter("_pos IS NOT NULL")
    found = lookup(long, unique_keys(words, "token_id", "token"), F.col("_id") == F.col("token_id"))
    joined = found.groupBy("_row").agg(F.expr("listagg(token, '') within group (order by _pos)").alias("text"))
    return rows.select("_row", *keys).join(joined, "_row", "left").select(*keys, F.coalesce("text", F.lit("")).alias("text"))
