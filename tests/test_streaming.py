"""Streams over several files must give the rows of the batch forms."""

import pytest
from conftest import bag_of, rows_of
from pyspark.sql import functions as F

from corpusloom.operators.chunks import assemble_text
from corpusloom.plans.prompts import conversation_prompts
from corpusloom.plans.replies import filter_replies
from corpusloom.streaming.history import closing_turns, stream_history
from corpusloom.streaming.replies import stream_reply_filter
from corpusloom.streaming.sessions import stream_idle_sessions
from corpusloom.streaming.tables import RowsLeft, drain, read_batches, read_stream, write_batches
from corpusloom.streaming.timeouts import end_of_input, without_times

WORDS = ["ab ", "c", "<think>", "no", "</think>", "dd", " eee", "f ", "||END||", "", "gh"]


def in_files(spark, tmp_path, df, part, n=3):
    """Write a table as ``n`` files of one folder; the stream takes one per trigger."""
    folder = str(tmp_path / "in")
    for i in range(n):
        df.filter(part % n == i).coalesce(1).write.mode("append").parquet(folder)
    return read_stream(spark, folder, df.schema, max_files=1)


@pytest.fixture
def chunks(spark):
    rows = []
    for s, n in [("a", 40), ("b", 9), ("c", 1), ("d", 25)]:
        for i in range(n):
            word = "xy " if s == "d" and i > 6 else WORDS[(i * (3 if s == "a" else 1) + len(s)) % len(WORDS)]
            rows.append((s, i, float(i), word, i == n - 1))
    return spark.createDataFrame(rows, "stream_id string, chunk_idx bigint, at double, content string, is_last boolean")


@pytest.mark.parametrize("tokens, window", [(1000, 4), (20, 4), (1000, 2)])
def test_reply_filter(spark, tmp_path, chunks, tokens, window):
    batch = filter_replies(chunks, max_tokens=tokens, window=window)
    # chunks of one stream arrive out of order over the triggers
    stream = in_files(spark, tmp_path, chunks, F.col("chunk_idx"))
    assert bag_of(drain(stream_reply_filter(stream, tokens, window=window))) == bag_of(batch)


def test_reply_filter_clock(spark, tmp_path, chunks):
    timed = chunks.withColumn("ts", F.timestamp_seconds("at"))
    batch = filter_replies(timed, max_seconds=7, ts="ts").select("stream_id", "chunk_idx", "content")
    stream = in_files(spark, tmp_path, chunks, F.col("chunk_idx"))
    assert bag_of(drain(stream_reply_filter(stream, max_seconds=7))) == bag_of(batch)


def test_history(spark, tmp_path):
    rows = []
    for conv in range(4):
        for turn in range(12):
            role = "system" if turn == 0 and conv == 1 else ("user" if turn % 2 else "assistant")
            text = "reset" if (conv, turn) == (2, 5) else "quit" if (conv, turn) == (3, 7) else f"你{turn}" if conv == 0 else f"m{turn}"
            rows.append((conv, turn, role, text))
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    batch = conversation_prompts(conv, {"en": "EN", "zh": "ZH"}, 2)
    stream = in_files(spark, tmp_path, conv, F.col("turn"))
    assert bag_of(drain(stream_history(stream, {"en": "EN", "zh": "ZH"}, 2))) == bag_of(batch)


def test_history_with_gaps(spark, tmp_path):
    rows = []
    for conv, missing in [(0, {0}), (1, {4, 5}), (2, {0, 3, 9}), (3, set())]:
        for turn in sorted(set(range(12)) - missing):
            text = "reset" if (conv, turn) == (2, 5) else "quit" if (conv, turn) == (1, 9) else f"m{turn}"
            rows.append((conv, turn, "user" if turn % 2 else "assistant", text))
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    batch = conversation_prompts(conv, {"en": "EN"}, 2)
    in_files(spark, tmp_path, conv, F.col("turn"))
    closing_turns(conv).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), conv.schema, max_files=1)
    assert bag_of(drain(stream_history(stream, {"en": "EN"}, 2))) == bag_of(batch)


def backlog(spark, tmp_path, df, part, n=3):
    """A stream over ``n`` files in any order, with times, and the end of its input."""
    timed = without_times(df, "ts")
    stream = in_files(spark, tmp_path, timed, part, n)
    return stream, lambda: end_of_input(timed, "ts").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


@pytest.mark.parametrize("missing, with_last", [((3,), True), ((0, 7), False), ((), False)])
def test_replies_behind_a_gap_come_out_at_the_end(spark, tmp_path, chunks, missing, with_last):
    some = chunks.filter(~F.col("chunk_idx").isin(*missing) if missing else F.lit(True))
    some = some if with_last else some.withColumn("is_last", F.lit(False))
    batch = bag_of(filter_replies(some.drop("is_last"), window=4))
    stream, end = backlog(spark, tmp_path, some, 60 - F.col("chunk_idx"))
    assert batch and bag_of(drain(stream_reply_filter(stream, window=4, ts="ts"), "gaps", end)) == batch


def test_history_ends_by_event_time(spark, tmp_path):
    rows = [(conv, turn, "user" if turn % 2 else "assistant", "reset" if (conv, turn) == (2, 5) else f"m{turn}")
            for conv, missing in [(0, {0}), (1, {4, 5}), (2, {0, 3, 9}), (3, set())] for turn in sorted(set(range(12)) - missing)]
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    batch = bag_of(conversation_prompts(conv, {"en": "EN"}, 2))
    stream, end = backlog(spark, tmp_path, conv, 60 - F.col("turn"))
    assert bag_of(drain(stream_history(stream, {"en": "EN"}, 2, ts="ts"), "ends", end)) == batch


def test_a_reply_ends_behind_the_watermark(spark, tmp_path):
    rows = [("a", 0, 0, "one "), ("a", 2, 1, "three "), ("b", 0, 500, "later "), ("c", 0, 900, "last ")]
    df = spark.createDataFrame(rows, "stream_id string, chunk_idx bigint, t bigint, content string")
    df = df.select("stream_id", "chunk_idx", F.lit(None).cast("double").alias("at"), "content", F.lit(False).alias("is_last"), F.timestamp_seconds(F.col("t") + 1_000_000).alias("ts"))
    folder = str(tmp_path / "in")
    for part in (df.filter("stream_id = 'a'"), df.filter("stream_id <> 'a'")):
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = read_stream(spark, folder, df.schema, max_files=1)
    out = drain(stream_reply_filter(stream, idle_ms=60_000, ts="ts", delay="0 seconds"))
    # the later times end a, whose two chunks stand apart and are held together; whole chunks come out at once
    assert sorted(rows_of(out, "stream_id", "chunk_idx", "content")) == [("a", 0, "one three "), ("b", 0, "later "), ("c", 0, "last ")]


def test_an_unfinished_stream_is_an_error(spark, tmp_path, chunks):
    stream, _ = backlog(spark, tmp_path, chunks.withColumn("is_last", F.lit(False)), F.col("chunk_idx"), 2)
    with pytest.raises(RowsLeft):
        drain(stream_reply_filter(stream, ts="ts"), "unfinished", lambda: None)


def test_idle_history_comes_out(spark, tmp_path):
    rows = [(1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 5, "user", "c"), (2, 0, "user", "d")]
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    batch = bag_of(conversation_prompts(conv, {"en": "EN"}, 2))
    prompts = stream_history(in_files(spark, tmp_path, conv, F.col("turn"), 1), {"en": "EN"}, 2, idle_ms=500)
    query = prompts.writeStream.format("memory").queryName("idle_history").outputMode("append").start()
    try:
        for _ in range(60):
            if spark.table("idle_history").count() >= len(batch):
                break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert bag_of(spark.table("idle_history")) == batch


def test_drain_keeps_every_chunk(spark, tmp_path, chunks):
    stream = in_files(spark, tmp_path, chunks, F.col("chunk_idx"))
    assert bag_of(assemble_text(drain(stream))) == bag_of(assemble_text(chunks))


def test_sessions_close_after_the_timeout(spark, tmp_path):
    rows = [(1, 0), (1, 600), (1, 1201), (2, 100), (2, 5000), (3, 9000)]
    df = spark.createDataFrame(rows, "user_id int, t bigint").withColumn("ts", F.timestamp_seconds("t"))
    folder = str(tmp_path / "in")
    for t in (600, 1300, 9000):
        df.filter(F.col("t") <= t).filter(F.col("t") > {600: -1, 1300: 600, 9000: 1300}[t]).coalesce(1).write.mode("append").parquet(folder)
    out = drain(stream_idle_sessions(read_stream(spark, folder, df.schema, max_files=1), 600, "0 seconds"))
    seconds = out.select("user_id", F.unix_timestamp("first_ts").alias("a"), F.unix_timestamp("last_ts").alias("b"), "n")
    assert sorted(rows_of(seconds, "user_id", "a", "b", "n")) == [(1, 0, 600, 2), (1, 1201, 1201, 1), (2, 100, 100, 1), (2, 5000, 5000, 1)]


def test_a_lost_batch_is_written_once(spark, tmp_path):
    """Runs that end between the write of a batch and its commit, and then go on."""
    source, path, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.range(100).withColumn("word", F.lit("a")).repartition(5, "id").write.parquet(source)
    schema = spark.read.parquet(source).schema
    lost = []

    def lose_some(number):
        if number in (0, 2) and number not in lost:
            lost.append(number)
            raise RuntimeError("lost")

    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            write_batches(read_stream(spark, source, schema, 1), path, progress, written=lose_some)
    write_batches(read_stream(spark, source, schema, 1), path, progress, written=lose_some)
    found = read_batches(spark, path, schema)
    assert sorted(r["id"] for r in found.collect()) == list(range(100)) and lost == [0, 2]
    # nothing new: nothing is written
    write_batches(read_stream(spark, source, schema, 1), path, progress)
    assert found.select("batch_id").distinct().count() == 5 and found.count() == 100


def test_streams_share_states(spark, tmp_path):
    """A state per bucket, not per stream; streams of one bucket keep apart, also by the null that ends the input."""
    rows = spark.range(60).selectExpr("id + 9007199254740992 AS stream_id", "explode(array(2, 0, 1)) AS chunk_idx")
    rows = rows.selectExpr("*", "concat('word', stream_id % 7, chunk_idx, ' ') AS content", "CAST(NULL AS DOUBLE) AS at", "chunk_idx = 2 AND stream_id % 2 = 0 AS is_last")
    rows = without_times(rows, "ts")
    folder = str(tmp_path / "in")
    rows.repartition(2, "chunk_idx").write.parquet(folder)
    stream = stream_reply_filter(read_stream(spark, folder, rows.schema, max_files=1), ts="ts", buckets=4)
    out = str(tmp_path / "out")
    query = stream.writeStream.format("parquet").option("checkpointLocation", out + "-progress").trigger(availableNow=True).start(out)
    query.awaitTermination()
    assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    drained = drain(stream, "shared", lambda: end_of_input(rows, "ts").coalesce(1).write.mode("append").parquet(folder))
    assert drained.schema["stream_id"].dataType.simpleString() == "bigint"
    assert bag_of(drained) == bag_of(rows.select("stream_id", F.col("chunk_idx").cast("long"), "content"))
