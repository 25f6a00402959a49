"""Where queries register, and the derived tables they share with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import CHUNK_PATTERN
from corpusloom.operators.chunks import chunk_text
from corpusloom.plans.spread import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and texts, for work that is heavy on every text."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


# --- derived tables: a Spark form and a SQL form of each -----------------------------------------------

# every message cut into words: (stream_id, chunk_idx, content)
CHUNKS_SQL = f"""chunks AS (
  SELECT stream_id, CAST(i AS INTEGER) AS chunk_idx, pieces[i + 1] AS content
  FROM (SELECT stream_id, pieces, unnest(range(len(pieces))) AS i
        FROM (SELECT conv_id || ':' || turn AS stream_id, regexp_extract_all(text, '{CHUNK_PATTERN}') AS pieces
              FROM conversations)))"""


def streams_of(conv: DataFrame) -> DataFrame:
    return conv.select(F.concat_ws(":", "conv_id", "turn").alias("stream_id"), "text")


def message_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_text(streams_of(table(spark, sf_dir, "conversations")))


# the same with a hidden block: word 2 opens it and word 5 closes it, shorter messages never do
MARKED_SQL = (
    CHUNKS_SQL
    + """, marked AS (
  SELECT stream_id, chunk_idx,
         CASE chunk_idx WHEN 2 THEN '<think>' WHEN 5 THEN '</think>' ELSE content END AS content
  FROM chunks)"""
)


def with_markers(chunks: DataFrame) -> DataFrame:
    content = F.when(F.col("chunk_idx") == 2, "<think>").when(F.col("chunk_idx") == 5, "</think>")
    return chunks.withColumn("content", content.otherwise(F.col("content")))


# events as chunk streams of their users, in time order
EVENT_CHUNKS_SQL = """event_chunks AS (
  SELECT user_id AS stream_id, ts, event_id, event_type AS content FROM events)"""


def event_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("stream_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("event_type").alias("content")
    )


# conversations where some messages are commands and some are Chinese
COMMANDS_SQL = """talk AS (
  SELECT conv_id, turn, role,
         CASE WHEN role = 'user' AND turn = 4 AND conv_id % 2 = 0 THEN '\t Clear \n'
              WHEN role = 'user' AND turn = 5 AND conv_id % 3 = 0 THEN ' QUIT'
              WHEN role = 'user' AND conv_id % 5 = 0 THEN '你好。' || text
              ELSE text END AS text
  FROM conversations)"""


def command_talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return commands_in(table(spark, sf_dir, "conversations"))


def commands_in(conv: DataFrame) -> DataFrame:
    user = F.col("role") == "user"
    text = (
        F.when(user & (F.col("turn") == 4) & (F.col("conv_id") % 2 == 0), "\t Clear \n")
        .when(user & (F.col("turn") == 5) & (F.col("conv_id") % 3 == 0), " QUIT")
        .when(user & (F.col("conv_id") % 5 == 0), F.concat(F.lit("你好。"), "text"))
        .otherwise(F.col("text"))
    )
    return conv.withColumn("text", text)


TEMPLATES = {"en": "Answer in short, plain sentences.", "zh": "请用简短的句子回答。"}
TEMPLATE_SQL = f"CASE WHEN regexp_matches(first_user, '[\\x{{4E00}}-\\x{{9FFF}}]') THEN '{TEMPLATES['zh']}' ELSE '{TEMPLATES['en']}' END"

# one row per user message that is answered by the next row
PAIRS_SQL = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS prompt, a.text AS response
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant'
  WHERE u.role = 'user')"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    users = conv.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("prompt"))
    replies = conv.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response")
    )
    return users.join(replies, ["conv_id", "turn"], "left")
