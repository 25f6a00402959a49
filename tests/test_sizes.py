"""One result at every size, and what happens at the end of a stream."""

from collections import Counter

import pytest
from conftest import bag_of, rows_of
from pyspark.sql import functions as F

from corpusloom.operators.batching import batch_plan
from corpusloom.operators.retention import stale
from corpusloom.operators.sessions import idle_sessions
from corpusloom.operators.tokens import decode, encode
from corpusloom.plans.ordered import with_runs, without_runs
from corpusloom.plans.replies import filter_replies
from corpusloom.sources.catalog import Source, load_with_report
from corpusloom.streaming.replies import stream_reply_filter
from corpusloom.streaming.tables import drain, read_stream

VOCAB = [("<pad>", 0, True), ("</s>", 1, True), ("<unk>", 2, True), ("a", 3, False), ("b", 4, False), ("b", 5, False), (" ", 6, False)]


@pytest.mark.parametrize("limit", [2, None, 0])
def test_encode_and_decode_give_a_row_per_row(frame, limit):
    vocab = frame(VOCAB, "token string, token_id int, is_special boolean")
    docs = frame([(1, "a b"), (1, "a b"), (1, "b"), (2, ""), (None, "a x"), (3, None)], "doc_id long, text string")
    forms = []
    for inline in (100, 0):
        ids = encode(docs, vocab, limit, 2, pattern=".", max_inline=inline)
        forms.append((bag_of(ids), ids.schema.simpleString(), bag_of(decode(ids, vocab, max_inline=inline))))
    assert forms[0] == forms[1] and len(forms[0][0]) == 6
    if limit is None:
        assert (1, [3, 6, 4]) in [(r[0], r[1]) for r in forms[0][0]]


def test_a_split_changes_neither_schema_nor_rows(frame):
    events = frame([(k % 2, F_TIME + 700 * k, k) for k in range(40)], "user_id long, t long, event_id long").withColumn("ts", F.timestamp_seconds("t"))
    keys, order = ["user_id"], ["ts", "event_id"]
    whole, split = (idle_sessions(with_runs(events, keys, order, n)) for n in (1000, 6))
    assert whole.schema.simpleString() == split.schema.simpleString()
    assert bag_of(without_runs(whole)) == bag_of(without_runs(split))


F_TIME = 1_700_000_000
CHUNKS = "stream_id string, chunk_idx bigint, content string"


def chunk_rows(name, *words):
    return [(name, i, w) for i, w in enumerate(words)]


def test_a_budget_stop_has_no_rest(frame):
    chunks = frame(chunk_rows("cut", "hello ", "ab", "cd", "world ") + chunk_rows("end", "hello ", "ab"), CHUNKS)
    got = rows_of(filter_replies(chunks, max_tokens=2), "stream_id", "content")
    assert sorted(got) == [("cut", "hello "), ("end", "ab"), ("end", "hello ")]


def test_the_rest_is_not_tested_for_repetition(frame):
    chunks = frame(chunk_rows("s", "abcd ", "x", "x") + chunk_rows("t", "xx", "xxx", "xx", "xxx", "xx"), CHUNKS)
    got = rows_of(filter_replies(chunks, window=2, min_len=2), "stream_id", "content")
    assert ("s", "xx") in got
    tail = frame(chunk_rows("s", "aa", "a"), CHUNKS)
    assert sorted(rows_of(filter_replies(tail, window=2, min_len=2), "content")) == ["a", "aa"]


@pytest.mark.parametrize("split_above, beyond", [(1000, False), (25, False), (1000, True)])
def test_tasks_of_the_reply_guards_hold_a_bounded_number_of_chunks(frame, monkeypatch, split_above, beyond):
    import corpusloom.plans.replies as replies

    rows = [row for s in range(300) for row in chunk_rows(f"s{s}", *[f"w{k * k % 7}{s} " for k in range(10 + (s % 5) * 5)])]
    chunks = frame(rows, CHUNKS)
    want = bag_of(filter_replies(chunks, max_tokens=28, window=4))
    if beyond:
        monkeypatch.setattr(replies, "BLOCK_ROWS", 10)
    got = filter_replies(chunks, max_tokens=28, window=4, split_above=split_above, part_rows=200)
    held = Counter(r[0] for r in got.select(F.spark_partition_id()).collect())
    assert len(held) > 20 and max(held.values()) < 600 < len(rows) / 8
    assert bag_of(got) == want


def test_budgets_beyond_a_block_are_kept(frame, monkeypatch):
    import corpusloom.plans.replies as replies

    chunks = frame(chunk_rows("s", *[f"word{k} " for k in range(40)]), CHUNKS)
    want = bag_of(filter_replies(chunks, max_tokens=30))
    monkeypatch.setattr(replies, "BLOCK_ROWS", 10)
    assert bag_of(filter_replies(chunks, max_tokens=30, split_above=8)) == want


def test_stream_ends_like_the_batch(spark, tmp_path, frame):
    rows = chunk_rows("cut", "hello ", "ab", "cd", "world ") + chunk_rows("end", "aa bb", "a")
    chunks = frame([(*r, None, r[1] == (3 if r[0] == "cut" else 1)) for r in rows], CHUNKS + ", at double, is_last boolean")
    folder = str(tmp_path / "in")
    chunks.coalesce(1).write.parquet(folder)
    stream = stream_reply_filter(read_stream(spark, folder, chunks.schema), max_tokens=2)
    assert bag_of(drain(stream)) == bag_of(filter_replies(frame(rows, CHUNKS), max_tokens=2))


def test_batch_order_does_not_depend_on_buckets(frame):
    df = frame([(k,) for k in range(200)], "id long")
    assert bag_of(batch_plan(df, "id", epochs=20)) == bag_of(batch_plan(df, "id", epochs=20, bucket_digits=3))


def test_stale_files_of_one_group_by_name(frame):
    files = frame([("g", "b", 9), ("h", "a", 9), ("h", "b", 1), (None, "b", 5), (None, "c", 6)], "grp string, path string, modificationTime long")
    assert sorted(rows_of(stale(files, 1, ["grp"]), "grp", "path"), key=repr) == [("h", "b"), (None, "b")]


def test_any_failure_of_a_source_is_a_row(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))

    def fails(df):
        raise KeyError()

    sources = [Source("bad", str(tmp_path / "t"), prepare=fails), Source("good", str(tmp_path / "t"))]
    tables, report = load_with_report(spark, sources)
    assert list(tables) == ["good"]
    assert {r["source"]: (r["status"], r["error"]) for r in report.collect()} == {"bad": ("failed", "KeyError"), "good": ("loaded", None)}


def test_ordered_files_grow_in_number_not_in_size(spark, monkeypatch):
    import checks.ingest as ingest

    folder = "/root/testdata/sf0.001"
    want = bag_of(ingest.c1_ordered_rows(spark, folder))
    monkeypatch.setattr(ingest, "FILE_BYTES", 4096)
    written = []
    monkeypatch.setattr(ingest, "save_dataset", lambda df, path: (written.append(df.rdd.getNumPartitions()), df.write.parquet(path)))
    assert bag_of(ingest.c1_ordered_rows(spark, folder)) == want
    assert max(written) > 5
