"""Vocabulary, token arrays, batch plan."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import documents, query, table
from corpusloom.functions.arrays import CPU_MAX_LENGTH, attention_mask, last_n, mask_labels, pad_truncate
from corpusloom.functions.text import TOKEN_PATTERN
from corpusloom.operators.batching import batch_plan
from corpusloom.operators.tokens import (
    build_vocab,
    copy_labels,
    decode,
    encode,
    training_arrays,
    with_pad,
)
from corpusloom.session import materialize

SIZE = 3000
MAX_LEN = CPU_MAX_LENGTH
WHOLE = None  # no limit

TOKENS_SQL = f"regexp_extract_all(text, '{TOKEN_PATTERN}')"
VOCAB_SQL = f"""
vocab AS (
  SELECT '<pad>' AS token, 0 AS token_id, true AS is_special, 0 AS n
  UNION ALL SELECT '</s>', 1, true, 0 UNION ALL SELECT '<unk>', 2, true, 0
  UNION ALL
  SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) + 2 AS INTEGER), false, n
  FROM (SELECT token, count(*) AS n FROM (SELECT unnest({TOKENS_SQL}) AS token FROM documents)
        WHERE token NOT IN ('<pad>', '</s>', '<unk>') GROUP BY token ORDER BY n DESC, token LIMIT {SIZE}))"""


def _encoded_sql(length: str) -> str:
    return f"""{VOCAB_SQL},
long AS (
  SELECT doc_id, i AS pos, ts[i + 1] AS token FROM (
    SELECT doc_id, ts, unnest(range(len(ts))) AS i FROM (SELECT doc_id, {TOKENS_SQL}{length} AS ts FROM documents))),
encoded AS (
  SELECT d.doc_id, coalesce(ids, CAST([] AS INTEGER[])) AS ids FROM documents d LEFT JOIN (
    SELECT doc_id, list(coalesce(token_id, 2) ORDER BY pos) AS ids FROM long LEFT JOIN vocab USING (token) GROUP BY doc_id) e USING (doc_id))"""


ENCODED_SQL, WHOLE_SQL = _encoded_sql(f"[1:{MAX_LEN}]"), _encoded_sql("")
IDS_SQL = f"list_concat(ids[1:{MAX_LEN}], list_transform(range(greatest({MAX_LEN} - len(ids), 0)), lambda i: 0))"
MASK_SQL = f"list_transform(range({MAX_LEN}), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END)"


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(build_vocab(documents(spark, sf_dir), SIZE), "vocab")


def _encoded(spark: SparkSession, sf_dir: str, max_len: int | None = MAX_LEN) -> DataFrame:
    return encode(documents(spark, sf_dir), _vocab(spark, sf_dir), max_len, 2)


def _text(name: str):
    return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)


@query(f"WITH {VOCAB_SQL} SELECT token, token_id, is_special, n FROM vocab")
def i0_build_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocab(documents(spark, sf_dir), SIZE)


@query(f"WITH {WHOLE_SQL} SELECT doc_id, array_to_string(ids, ',') AS input_ids FROM encoded")
def i1_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir, WHOLE).select("doc_id", _text("input_ids"))


_JOINED = 10  # a vocabulary of more tokens is joined


def _twice(df: DataFrame) -> DataFrame:
    """Every row two times, so that ids repeat."""
    return df.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")


@query(f"WITH {WHOLE_SQL} SELECT doc_id, array_to_string(ids, ',') AS input_ids FROM encoded, (SELECT unnest([0, 1]))")
def i1_encode_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(_twice(documents(spark, sf_dir)), _vocab(spark, sf_dir), WHOLE, 2, max_inline=_JOINED)
    return encoded.select("doc_id", _text("input_ids"))


@query(f"WITH {WHOLE_SQL} SELECT doc_id, CAST(pos AS INTEGER) AS pos, coalesce(token_id, 2) AS token_id FROM long LEFT JOIN vocab USING (token)")
def d2_vocab_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir, WHOLE).select("doc_id", F.posexplode("input_ids").alias("pos", "token_id"))


@query(f"WITH {ENCODED_SQL} SELECT doc_id, array_to_string({IDS_SQL}, ',') AS input_ids FROM encoded")
def i2_pad_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = _encoded(spark, sf_dir).select("doc_id", pad_truncate("input_ids", MAX_LEN, 0).alias("input_ids"))
    return padded.select("doc_id", _text("input_ids"))


@query(f"WITH {ENCODED_SQL} SELECT doc_id, array_to_string({MASK_SQL}, ',') AS attention_mask FROM encoded")
def i3_attention_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    masked = _encoded(spark, sf_dir).select("doc_id", attention_mask("input_ids", MAX_LEN).alias("attention_mask"))
    return masked.select("doc_id", _text("attention_mask"))


@query(f"WITH {WHOLE_SQL} SELECT doc_id, array_to_string(ids, ',') AS labels FROM encoded")
def i4_copy_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copy_labels(_encoded(spark, sf_dir, WHOLE)).select("doc_id", _text("labels"))


@query(
    f"""WITH {WHOLE_SQL} SELECT doc_id, array_to_string(
        list_transform(list_concat(ids, [0, 0, 0]), lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ',') AS labels FROM encoded"""
)
def i5_mask_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = _encoded(spark, sf_dir, WHOLE).select("doc_id", F.concat("input_ids", F.array_repeat(F.lit(0), 3)).alias("ids"))
    return padded.select("doc_id", mask_labels("ids", 0).alias("labels")).select("doc_id", _text("labels"))


@query(
    f"""WITH {ENCODED_SQL} SELECT doc_id, array_to_string({IDS_SQL}, ',') AS input_ids,
        array_to_string({MASK_SQL}, ',') AS attention_mask,
        array_to_string(list_transform({IDS_SQL}, lambda x: CASE WHEN x = 0 THEN -100 ELSE x END), ',') AS labels FROM encoded"""
)
def training_arrays_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    arrays = training_arrays(_encoded(spark, sf_dir), MAX_LEN, 0)
    return arrays.select("doc_id", _text("input_ids"), _text("attention_mask"), _text("labels"))


# a special-token row per language; the pad token is known for some only
@query(
    """SELECT lang, coalesce(pad_token, eos_token) AS pad_token, eos_token FROM (
      SELECT lang, CASE WHEN count(*) FILTER (source = 'src0') % 2 = 0 THEN '<pad>' END AS pad_token, '</s>' AS eos_token
      FROM documents GROUP BY lang)"""
)
def i6_pad_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_lang = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count_if(F.col("source") == "src0").alias("n"))
    special = per_lang.select("lang", F.when(F.col("n") % 2 == 0, "<pad>").alias("pad_token"), F.lit("</s>").alias("eos_token"))
    return with_pad(special)


@query(
    f"""WITH {WHOLE_SQL}, words AS (
      SELECT doc_id, string_agg(CASE WHEN coalesce(token_id, 2) > 2 THEN token ELSE '' END, '' ORDER BY pos) AS text
      FROM long LEFT JOIN vocab USING (token) GROUP BY doc_id)
    SELECT doc_id, coalesce(words.text, '') AS text FROM documents LEFT JOIN words USING (doc_id)"""
)
def i7_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    return decode(encode(documents(spark, sf_dir), vocab, WHOLE, 2), vocab)


@query(
    f"""WITH {WHOLE_SQL}, words AS (
      SELECT doc_id, string_agg(CASE WHEN coalesce(token_id, 2) > 2 THEN token ELSE '' END, '' ORDER BY pos) AS text
      FROM long LEFT JOIN vocab USING (token) GROUP BY doc_id)
    SELECT doc_id, coalesce(words.text, '') AS text FROM documents LEFT JOIN words USING (doc_id), (SELECT unnest([0, 1]))"""
)
def i7_decode_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    return decode(_twice(encode(documents(spark, sf_dir), vocab, WHOLE, 2)), vocab, max_inline=_JOINED)


@query(
    """SELECT vec_id, array_to_string(list_transform(embedding[-4:], lambda x: CAST(round(CAST(x AS DOUBLE) * 1000) AS BIGINT)), ',') AS tail,
       CAST(len(embedding) AS INTEGER) AS n FROM embeddings"""
)
def i8_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = F.transform(last_n("embedding", 4), lambda x: F.round(x.cast("double") * 1000).cast("long").cast("string"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(tail, ",").alias("tail"), F.size("embedding").alias("n"))


@query(
    """SELECT CAST(epoch AS INTEGER) AS epoch, rn, rn // 2 AS micro_batch, rn // 32 AS step, doc_id FROM (
      SELECT epoch, doc_id, row_number() OVER (PARTITION BY epoch ORDER BY md5('42|' || epoch || '|' || doc_id), doc_id) - 1 AS rn
      FROM documents, (SELECT unnest(range(3)) AS epoch))"""
)
def f10_batch_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_plan(table(spark, sf_dir, "documents"), "doc_id")
