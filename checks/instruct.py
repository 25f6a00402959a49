"""Instruction examples, projections, row functions."""

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import PAIRS_SQL, pairs, query, table
from corpusloom.functions.text import fill_template, prefix
from corpusloom.operators.concat import concat_datasets
from corpusloom.operators.instruct import (
    answer_of,
    drop_blank,
    drop_columns,
    fill_default_prompt,
    keep_columns,
    known_roles,
    prompt_of,
    render_fallback,
    render_instruction,
)
from corpusloom.operators.rows import map_batches, map_rows, value_or, with_fallback

LEAD = "You help with questions about texts.\n\n"
DEFAULT = "Write a short text."

# documents with every seventh text blank, next to prompts and benchmark inputs
_MIXED_SQL = """mixed AS (
  SELECT CASE WHEN doc_id % 7 = 0 THEN '' ELSE text END AS text, NULL AS prompt, NULL AS input,
         NULL AS response, CASE WHEN doc_id % 2 = 0 THEN lang END AS target, 'd' || doc_id AS id FROM documents
  UNION ALL SELECT NULL, NULL, text, '', NULL, 'b' || item_id FROM benchmark
  UNION ALL SELECT NULL, prompt, NULL, response, NULL, conv_id || ':' || turn FROM pairs)"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("text")).alias("text"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("target"),
        F.concat(F.lit("d"), "doc_id").alias("id"),
    )
    bench = table(spark, sf_dir, "benchmark").select(
        F.col("text").alias("input"), F.lit("").alias("response"), F.concat(F.lit("b"), "item_id").alias("id")
    )
    talk = pairs(spark, sf_dir).select("prompt", "response", F.concat_ws(":", "conv_id", "turn").alias("id"))
    return concat_datasets([docs, bench, talk], order_column=None)


_PROMPT = "coalesce(nullif(text, ''), nullif(prompt, ''), nullif(input, ''))"
_ANSWER = "coalesce(nullif(response, ''), nullif(target, ''))"


@query(f"WITH {PAIRS_SQL}, {_MIXED_SQL} SELECT id, {_PROMPT} AS prompt FROM mixed")
def b2_prompt_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _mixed(spark, sf_dir)
    return df.select("id", prompt_of(df).alias("prompt"))


@query(f"WITH {PAIRS_SQL}, {_MIXED_SQL} SELECT id, {_ANSWER} AS answer FROM mixed")
def b3_answer_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _mixed(spark, sf_dir)
    return df.select("id", answer_of(df).alias("answer"))


@query(f"WITH {PAIRS_SQL}, {_MIXED_SQL} SELECT id, coalesce({_PROMPT}, '{DEFAULT}') AS prompt FROM mixed")
def b4_fill_default_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _mixed(spark, sf_dir)
    return fill_default_prompt(df.select("id", prompt_of(df).alias("prompt")), "prompt", DEFAULT)


@query(
    f"""WITH {PAIRS_SQL} SELECT conv_id, turn, prompt, response,
        '{LEAD}User: ' || prompt || '\nAssistant: ' || coalesce(response, '') AS text FROM pairs"""
)
def b5_render_instruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_instruction(pairs(spark, sf_dir), LEAD, default=DEFAULT)


@query(
    f"""WITH {PAIRS_SQL}, {_MIXED_SQL} SELECT id,
        '{LEAD}User: ' || coalesce({_PROMPT}, '{DEFAULT}') || '\nAssistant: ' || coalesce({_ANSWER}, '') AS text FROM mixed"""
)
def b5_render_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_instruction(_mixed(spark, sf_dir), LEAD, default=DEFAULT).select("id", "text")


@query(
    f"""SELECT doc_id, '{LEAD}User: Write a text based on: ' || left(text, 50) || '...\nAssistant: ' AS text
        FROM documents"""
)
def b6_render_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_fallback(table(spark, sf_dir, "documents").select("doc_id", "text"), LEAD)


@query("SELECT doc_id, lang FROM documents")
def b7_keep_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_columns(table(spark, sf_dir, "documents"), ("doc_id", "lang", "labels"))


@query("SELECT doc_id, lang FROM documents")
def b7_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(table(spark, sf_dir, "documents"), ("text", "source", "n_chars"))


@query(
    """SELECT doc_id, text FROM (SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN ' \t\n　' ELSE text END AS text
       FROM documents) WHERE trim(text, ' \t\n\r　 ') <> ''"""
)
def b8_drop_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    which = F.col("doc_id") % 7
    text = F.when(which == 0, "").when(which == 1, " \t\n　").otherwise(F.col("text"))
    return drop_blank(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), "text")


@query("SELECT conv_id, turn, role FROM conversations WHERE role IN ('user', 'assistant')")
def b9_known_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return known_roles(table(spark, sf_dir, "conversations"), ("user", "assistant")).select("conv_id", "turn", "role")


@query("SELECT doc_id, lang || '/' || source || ': ' || text AS label FROM documents")
def h1_fill_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", fill_template("{a}/{b}: {c}", a="lang", b="source", c="text").alias("label"))


@query("SELECT doc_id, left(text, 50) AS head FROM documents")
def h2_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", prefix("text", 50).alias("head"))


@query("SELECT doc_id, text, CAST(length(text) AS INTEGER) AS n FROM documents")
def u1_map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return map_rows(docs, lambda row: {"n": len(row["text"])}, "n int")


@query("SELECT doc_id, upper(lang) AS lang, n_chars * 2 AS twice FROM documents")
def u2_map_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")

    def double(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": batch["lang"].str.upper(), "twice": batch["n_chars"] * 2})

    return map_batches(docs, double, "lang string, twice bigint", remove=("n_chars",))


@query("SELECT event_id, coalesce(TRY_CAST(CASE WHEN event_id % 3 = 1 THEN event_type ELSE CAST(event_id AS VARCHAR) END AS BIGINT), 0) AS n FROM events")
def u3_with_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 3 == 1, F.col("event_type")).otherwise(F.col("event_id").cast("string"))
    df = events.select("event_id", raw.alias("raw"))
    return with_fallback(
        df,
        lambda d: d.select("event_id", F.col("no_such_column").alias("n")),
        lambda d: d.select("event_id", value_or(F.col("raw").try_cast("bigint"), F.lit(0).cast("bigint")).alias("n")),
    )
