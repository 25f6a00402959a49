"""One key holds a third of all rows or more: split runs must give what plain windows give."""

import random

import pytest
from conftest import SF, bag_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import chunks as chunk_operators
from corpusloom.operators.chunks import (
    budget_guard,
    budget_stops,
    rechunk,
    repetition_guard,
    suppress_think,
    take_until_sentinel,
)
from corpusloom.operators.conversations import (
    attach_system_prompt,
    cut_at_exit,
    mark_segments,
    prompt_at_turn,
    segment_on_reset,
    trim_history,
)
from corpusloom.operators.sessions import idle_sessions
from corpusloom.operators.tokens import build_vocab, decode, encode
from corpusloom.plans.lookup import lookup
from corpusloom.plans.ordered import RUN, is_split, with_runs, without_runs
from corpusloom.plans.prompts import conversation_prompts
from corpusloom.plans.text import ordered_concat
from corpusloom.session import materialize

CHUNK = "stream_id string, chunk_idx int, at bigint, content string"
CONV = "conv_id bigint, turn bigint, role string, text string"


@pytest.fixture(scope="module")
def chunks(spark):
    rng = random.Random(7)
    rows, at = [], 0
    for key, n in [("hot", 120), ("warm", 40), (None, 30)] + [(f"k{i}", 5) for i in range(20)]:
        for i in range(n):
            at += rng.choice([1, 5, 700])
            word = rng.choice(["a ", "bb ", "ccc ", "", "x", "<think>", "</think>", "<think>y</think>"] + ["d "] * 8)
            rows.append((key, i, at, word))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, CHUNK).withColumn("ts", F.timestamp_seconds("at"))


@pytest.fixture(scope="module")
def talk(spark):
    rng = random.Random(3)
    rows = []
    for conv, n in [(1, 150), (2, 40)] + [(i, 6) for i in range(3, 20)]:
        for turn in range(n):
            role = rng.choice(["user", "user", "assistant", "assistant", "tool"])
            if turn == 0 and conv % 2:
                role = "system"
            text = rng.choice(["clear", "你好", "hi", "so"] + ["word"] * 20) + (str(turn) if role != "user" else "")
            if conv == 2 and turn == 30:
                role, text = "user", " Exit"
            rows.append((conv, turn, role, text))
    return spark.createDataFrame(rows, CONV)


def split(df, keys, order, max_rows=16):
    out = with_runs(df, keys, order, max_rows)
    assert RUN in out.columns and out.count() == df.count()
    per_run = out.filter(f"{RUN} >= 0").groupBy(RUN).count()
    assert per_run.count() > 3
    assert per_run.agg(F.max("count")).first()[0] <= 3 * max_rows
    return out


STREAM_OPERATORS = {
    "budget": lambda df: budget_guard(df, 50, 9000),
    "tokens": lambda df: budget_guard(df, 50, ts=None),
    "stops": lambda df: budget_stops(df, 50, 9000),
    "think": suppress_think,
    "sentinel": lambda df: take_until_sentinel(df, "bb "),
    "repetition 2": lambda df: repetition_guard(df, 2, block_rows=4),
    "repetition 6": lambda df: repetition_guard(df, 6, block_rows=8),
    "sessions": lambda df: idle_sessions(df, 600, ["stream_id"], "ts", ["chunk_idx"]),
}


@pytest.mark.parametrize("name", STREAM_OPERATORS)
def test_streams(chunks, name):
    operator = STREAM_OPERATORS[name]
    plain = bag_of(without_runs(operator(chunks)))
    assert plain and bag_of(without_runs(operator(split(chunks, ["stream_id"], ["chunk_idx"])))) == plain


TALK_OPERATORS = {
    "trim 1": lambda df: trim_history(df, 1),
    "trim 3": lambda df: trim_history(df, 3),
    "segments": mark_segments,
    "segments with system": segment_on_reset,
    "exit": cut_at_exit,
    "system": lambda df: attach_system_prompt(df, {"en": "EN", "zh": "ZH"}),
    "prompts 1": lambda df: prompt_at_turn(df, 1),
    "prompts 4": lambda df: prompt_at_turn(mark_segments(df), 4),
    "prompts with templates": lambda df: prompt_at_turn(mark_segments(df), 2, templates={"en": "EN", "zh": "ZH"}),
    "chain": lambda df: prompt_at_turn(attach_system_prompt(mark_segments(cut_at_exit(df)), {"en": "EN"}), 2),
}


@pytest.mark.parametrize("name", TALK_OPERATORS)
def test_conversations(talk, name):
    operator = TALK_OPERATORS[name]
    plain = bag_of(without_runs(operator(talk)))
    assert plain and bag_of(without_runs(operator(split(talk, ["conv_id"], ["turn"])))) == plain


def simulated_prompts(rows, rounds):
    """The append / trim loop over one conversation at a time."""
    out = []
    by_conv = {}
    for conv, turn, role, text in sorted(rows):
        by_conv.setdefault(conv, []).append((turn, role, text))
    tags = {"system": "<|system|>", "user": "<|user|>", "assistant": "<|assistant|>"}
    for conv, messages in by_conv.items():
        lead, history, segment, first = None, [], 0, None
        for turn, role, text in messages:
            if role == "user" and text.strip().lower() in ("exit", "quit"):
                break
            if role == "user" and text.strip().lower() in ("clear", "reset"):
                history, segment = [], segment + 1
                continue
            first = first or role
            if role == "system":
                lead = lead or (text if first == "system" else None)
                continue
            if role == "user" and lead is None:
                lead = "ZH" if "你" in text else "EN"
            history.append((role, text))
            if role == "assistant":
                history = history[-2 * rounds :]
            if role == "user":
                shown = [("system", lead), *history]
                out.append((conv, "".join(f"{tags[r]}\n{t}\n\n" for r, t in shown if r in tags) + "<|assistant|>", segment, turn))
    return sorted(out)


@pytest.mark.parametrize("rounds, split_above", [(1, None), (2, 16), (10, 1000)])
def test_prompts_match_the_loop(talk, rounds, split_above):
    got = conversation_prompts(talk, {"en": "EN", "zh": "ZH"}, rounds, split_above=split_above)
    assert sorted(rows_of(got, "conv_id", "prompt", "segment", "turn")) == simulated_prompts([tuple(r) for r in talk.collect()], rounds)


def test_templates_equal_an_attached_system_row(talk):
    templates = {"en": "EN", "zh": "ZH"}
    attached = prompt_at_turn(attach_system_prompt(mark_segments(talk), templates), 3)
    assert bag_of(prompt_at_turn(mark_segments(talk), 3, templates=templates)) == bag_of(attached)


def test_small_keys_are_left_alone(chunks):
    whole = with_runs(chunks, ["stream_id"], ["chunk_idx"])
    assert not is_split(whole) and bag_of(without_runs(whole)) == bag_of(chunks)


def loop_rechunk(contents, min_len):
    out, held, start = [], "", None
    for i, c in enumerate(contents):
        if c:
            start = i if not held else start
            held += c
            if len(held) >= min_len:
                out.append((start, held))
                held = ""
    return out + [(start, held)] if held else out


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["", "a", "bb", "ccc", "dddd", "eeeee"]), max_size=40), st.sampled_from([1, 3, 5]), st.sampled_from([2, 3, 7, 64]))
def test_rechunk_blocks_match_a_loop(frame, contents, min_len, block_rows):
    df = frame([("s", i, c) for i, c in enumerate(contents)] + [("t", 0, "a")], "stream_id string, chunk_idx int, content string")
    got = rechunk(df, min_len, block_rows=block_rows).filter("stream_id = 's'").orderBy("chunk_idx")
    assert rows_of(got, "chunk_idx", "content") == loop_rechunk(contents, min_len)


def test_rechunk_of_many_blocks_composes_their_tables(spark, monkeypatch):
    monkeypatch.setattr(chunk_operators, "TREE_FAN", 3)
    rng = random.Random(9)
    streams = {f"s{k}": [rng.choice(["", "a", "bb", "ccc", "dddd"]) for _ in range(n)] for k, n in enumerate([200, 47, 3, 1])}
    df = spark.createDataFrame([(s, i, c) for s, cs in streams.items() for i, c in enumerate(cs)], "stream_id string, chunk_idx int, content string")
    nodes = []
    monkeypatch.setattr(chunk_operators, "materialize", lambda table, name: nodes.append((name, kept := materialize(table, name))) or kept)
    got = rechunk(df, 11, block_rows=2).orderBy("stream_id", "chunk_idx")
    want = [(s, *piece) for s, cs in streams.items() for piece in loop_rechunk(cs, 11)]
    assert rows_of(got, "stream_id", "chunk_idx", "content") == sorted(want)
    levels = [table for name, table in nodes if name == "rechunk-tables"]
    assert len(levels) == 5 and max(level.agg(F.max(F.size("_t"))).first()[0] for level in levels) == 3


def test_concat_blocks(spark):
    df = spark.range(100).selectExpr("id % 2 as k", "id as i", "cast(id as string) as v")
    whole = bag_of(ordered_concat(df, ["k"], "i", "v", "t", bounded=True))
    assert bag_of(ordered_concat(df, ["k"], "i", "v", "t", block_rows=7)) == whole


def test_lookup_beyond_the_broadcast_size(spark, frame):
    big = frame([("a",), ("b",), ("z",)], "w string")
    table = frame([("a", 1), ("b", 2), ("c", 3)], "t string, n int")
    on = F.col("w") == F.col("t")
    small_plan = lookup(big, table, on)._jdf.queryExecution().executedPlan().toString()
    large_plan = lookup(big, table, on, max_rows=2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small_plan and "SortMergeJoin" in large_plan
    assert bag_of(lookup(big, table, on)) == bag_of(lookup(big, table, on, max_rows=2))


@pytest.mark.parametrize("max_inline", [0, 100])
def test_encode_keeps_long_and_empty_rows(frame, max_inline):
    vocab = frame([("<unk>", 0, True), ("a", 1, False)], "token string, token_id int, is_special boolean")
    df = frame([(1, "a " * 500), (2, None)], "doc_id int, text string")
    encoded = encode(df, vocab, 300, 0, pattern=r"\w+", max_inline=max_inline)
    assert dict(rows_of(encoded, "doc_id", "input_ids")) == {1: [1] * 300, 2: []}
    assert dict(rows_of(decode(encoded, vocab, max_inline=max_inline), "doc_id", "text")) == {1: "a" * 300, 2: ""}


def test_inline_and_joined_lookups_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    vocab = materialize(build_vocab(docs, 700), "vocab")
    local, joined = (encode(docs, vocab, 50, 2, max_inline=n) for n in (1000, 10))
    assert "Exchange" not in local._jdf.queryExecution().optimizedPlan().toString()
    assert bag_of(local) == bag_of(joined)
    assert bag_of(decode(local, vocab, max_inline=1000)) == bag_of(decode(local, vocab, max_inline=10))


def test_looked_up_tokens_are_not_shuffled(spark):
    """The rows are dealt out before they are tokens; partial and final grouping stand in one stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    vocab = materialize(build_vocab(docs, 700), "vocab")
    encoded = encode(docs, vocab, None, 2, max_inline=10)
    for df in (encoded, decode(encoded, vocab, max_inline=10)):
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
        at = [k for k, line in enumerate(lines) if "ObjectHashAggregate" in line]
        assert len(at) == 2 and at[1] == at[0] + 1 and "REPARTITION_BY_NUM" in "".join(lines[at[1] :])


def test_many_runs_need_few_tasks(spark, monkeypatch):
    import corpusloom.plans.ordered as ordered

    monkeypatch.setattr(ordered, "RUN_TASKS", 3)
    df = spark.range(1000).selectExpr("CAST(id % 2 AS STRING) AS k", "999 - id AS i")
    out = with_runs(df, ["k"], ["i"], 10)
    runs = out.groupBy(RUN).agg(F.min(F.struct("k", "i")).alias("low"), F.max(F.struct("k", "i")).alias("high"), F.count("*").alias("n")).orderBy(RUN).collect()
    assert len(runs) >= 100 and max(r["n"] for r in runs) <= 10 and sum(r["n"] for r in runs) == 1000
    assert all(a["high"] < b["low"] for a, b in zip(runs, runs[1:]))
    assert out.filter(f"{RUN} >= 0").select(F.input_file_name()).distinct().count() <= 3
