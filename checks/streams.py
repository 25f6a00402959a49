"""Streaming queries over the stored tables; each must equal its batch form."""

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.chunks import FILTER_REPLIES_SQL, STRIP_SQL
from checks.conversations import PROMPTS_CHAIN_SQL, _sessions_sql
from checks.registry import CHUNKS_SQL, TEMPLATES, commands_in, query, streams_of, table, with_markers
from corpusloom.operators.chunks import assemble_text, chunk_text
from corpusloom.streaming.history import stream_history
from corpusloom.streaming.replies import stream_reply_filter
from corpusloom.session import scratch_path
from corpusloom.streaming.sessions import WHOLE_BACKLOG, closing_event, stream_idle_sessions
from corpusloom.streaming.tables import drain, read_batches, read_stream, write_batches
from corpusloom.streaming.timeouts import end_of_input, without_times


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_stream(spark, f"{sf_dir}/{name}.parquet", table(spark, sf_dir, name).schema)


@query("SELECT conv_id || ':' || turn AS stream_id, " + STRIP_SQL.format("text") + " AS text FROM conversations")
def k1_drain_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = chunk_text(streams_of(_stream(spark, sf_dir, "conversations")))
    return assemble_text(drain(chunks, "chunks"))


@query(
    """SELECT batch, user_id, event_id, row_number() OVER (PARTITION BY batch, user_id ORDER BY event_id) AS nth
       FROM (SELECT event_id % 3 AS batch, user_id, event_id FROM events)"""
)
def k1_batches_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch ranked on its own, which a stream can't do, with the first batch lost behind its write and run again."""
    folder, path = scratch_path(spark, "k1-events"), scratch_path(spark, "k1-batches")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_id") % 3).alias("batch"))
    for batch in range(3):
        events.filter(F.col("batch") == batch).coalesce(1).write.mode("append").parquet(folder)
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    stream = read_stream(spark, folder, events.schema, max_files=1)
    lost = []

    def lose_first(number: int) -> None:
        if not lost:
            lost.append(number)
            raise RuntimeError("the run is lost before it commits")

    ranked = lambda rows: rows.withColumn("nth", nth)
    try:
        write_batches(stream, path, f"{path}-progress", ranked, lose_first)
    except StreamingQueryException:
        pass
    write_batches(stream, path, f"{path}-progress", ranked)
    return read_batches(spark, path, ranked(events).schema).select("batch", "user_id", "event_id", "nth")


def _backlog(spark: SparkSession, df: DataFrame, name: str, files: int, order: str) -> tuple[DataFrame, Callable[[], None]]:
    """A table written in files that each hold rows from all over, as a stream with times; and the end of that input."""
    folder, timed = scratch_path(spark, name), without_times(df, "ts")
    timed.repartition(files, order).write.parquet(folder)
    stream = read_stream(spark, folder, timed.schema, max_files=1)
    return stream, lambda: end_of_input(timed, "ts").coalesce(1).write.mode("append").parquet(folder)


@query(FILTER_REPLIES_SQL)
def k2_stream_reply_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    chunks = with_markers(chunk_text(streams_of(conv), last="is_last")).withColumn("at", F.lit(None).cast("double"))
    stream, end = _backlog(spark, chunks, "chunks", 2, "chunk_idx")
    filtered = stream_reply_filter(stream, max_tokens=200, window=4, ts="ts")
    return drain(filtered, "replies", end).withColumn("chunk_idx", F.col("chunk_idx").cast("int"))


# the chunks of every stream but its fourth and its last, so that the rest stands behind a gap and no chunk is marked last
GAP_SQL = FILTER_REPLIES_SQL.replace(CHUNKS_SQL, CHUNKS_SQL.replace("chunks AS (", "all_chunks AS (", 1) + """, chunks AS (
  SELECT stream_id, chunk_idx, content FROM (
    SELECT *, max(chunk_idx) OVER (PARTITION BY stream_id) AS top FROM all_chunks) WHERE chunk_idx <> 3 AND chunk_idx < top)""")


@query(GAP_SQL)
def k2_stream_reply_filter_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    chunks = with_markers(chunk_text(streams_of(conv), last="is_last")).filter("chunk_idx <> 3 AND NOT is_last")
    stream, end = _backlog(spark, chunks.withColumn("at", F.lit(None).cast("double")), "chunks", 2, "chunk_idx")
    filtered = stream_reply_filter(stream, max_tokens=200, window=4, ts="ts")
    return drain(filtered, "replies", end).withColumn("chunk_idx", F.col("chunk_idx").cast("int"))


@query(PROMPTS_CHAIN_SQL)
def k3_stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream, end = _backlog(spark, commands_in(table(spark, sf_dir, "conversations")), "conversations", 2, "turn")
    return drain(stream_history(stream, TEMPLATES, max_rounds=1, ts="ts"), "prompts", end)


@query(
    f"""WITH {_sessions_sql(600)}
    SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n FROM sessions GROUP BY user_id, session"""
)
def k4_stream_idle_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    backlog = scratch_path(spark, "events")
    events.repartition(3, "ts").write.parquet(backlog)  # every file holds times from all over
    closing_event(events).write.mode("append").parquet(backlog)
    stream = read_stream(spark, backlog, events.schema, max_files=1)
    spans = drain(stream_idle_sessions(stream, delay=WHOLE_BACKLOG), "sessions")
    return spans.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "last_ts")})
