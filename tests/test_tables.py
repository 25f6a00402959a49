"""Hand-worked cases for the table operators."""

import pytest
from conftest import bag_of, rows_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from corpusloom.operators.batching import batch_plan
from corpusloom.operators.chunkers import chunk_with
from corpusloom.operators.chunks import (
    assemble_text,
    budget_guard,
    budget_stops,
    chunk_text,
    rechunk,
    repetition_guard,
    reply_metrics,
    suppress_think,
    take_until_sentinel,
)
from corpusloom.operators.classify import classify_listing
from corpusloom.operators.concat import SchemaClash, concat_datasets, concat_or_first
from corpusloom.operators.conversations import (
    attach_system_prompt,
    cut_at_exit,
    prompt_at_turn,
    render_prompt,
    segment_on_reset,
    trim_history,
)
from corpusloom.operators.instruct import (
    answer_of,
    fill_default_prompt,
    non_empty,
    prompt_of,
    render_fallback,
    render_instruction,
    require_columns,
)
from corpusloom.operators.retention import expired, newest, stale
from corpusloom.operators.rows import map_batches, map_rows, value_or, with_fallback
from corpusloom.operators.segments import segment_ids
from corpusloom.operators.sessions import idle_sessions
from corpusloom.operators.tokens import build_vocab, decode, encode, training_arrays
from corpusloom.plans.stages import run_stages

TEMPLATES = {"en": "EN", "zh": "ZH"}


# --- instruction examples -----------------------------------------------------------------------------


def test_prompt_and_answer_columns(frame):
    df = frame([("", "p", ""), (" ", "p", "t"), (None, None, None)], "text string, prompt string, target string")
    assert rows_of(df.select(prompt_of(df).alias("p"), answer_of(df).alias("a")), "p", "a") == [
        ("p", None),
        (" ", "t"),
        (None, None),
    ]
    bare = frame([(1,)], "id int")
    assert rows_of(bare.select(prompt_of(bare).alias("p")), "p") == [None]


@pytest.mark.parametrize(
    "schema, row, text",
    [
        ("text string, response string", ("q", "r"), "P\n\nUser: q\nBot: r"),
        ("prompt string", ("p",), "P\n\nUser: p\nBot: "),
        ("id int", (1,), "P\n\nUser: D\nBot: "),
    ],
)
def test_render_instruction(frame, schema, row, text):
    out = render_instruction(frame([row], schema), "P\n\n", bot_tag="Bot", default="D")
    assert rows_of(out, "text") == [text]


def test_default_prompts_are_counted_in_the_same_pass(frame):
    seen = Observation("defaults")
    df = frame([(None,), ("x",), (None,)], "p string")
    assert rows_of(fill_default_prompt(df, "p", "D", seen), "p") == ["D", "x", "D"]
    assert seen.get["default_prompts"] == 2


def test_render_fallback(frame):
    df = frame([("x" * 60,), (None,)], "text string")
    assert rows_of(render_fallback(df, template="[{start}]"), "text") == ["[" + "x" * 50 + "]", "[]"]


def test_gates(frame):
    df = frame([(1,)], "id int")
    with pytest.raises(ValueError, match="available columns"):
        require_columns(df)
    with pytest.raises(ValueError, match="empty"):
        non_empty(df.filter("id > 1"))
    assert non_empty(df) is df


def test_concat(frame):
    a, b = frame([(1, "x")], "id int, text string"), frame([(2, "y")], "id int, prompt string")
    both = concat_datasets([a, b])
    assert bag_of(both.select("id", "text", "prompt")) == [(1, None, "x"), (2, "y", None)]
    clash = frame([("1",)], "id string")
    with pytest.raises(SchemaClash):
        concat_datasets([a, clash])
    first, why = concat_or_first([a, clash])
    assert rows_of(first, "id", "text") == [(1, "x")] and "id" in why
    with pytest.raises(SchemaClash):
        concat_or_first([a, clash], strict=True)


# --- conversations ------------------------------------------------------------------------------------

CONV = "conv_id bigint, turn bigint, role string, text string"
ROLE = {"S": "system", "u": "user", "a": "assistant"}


def talk(frame, *texts, conv=1):
    return frame([(conv, i, ROLE.get(t[0], "user"), t) for i, t in enumerate(texts)], CONV)


def texts_of(df, *extra):
    return rows_of(df.orderBy(*extra, "turn"), *extra, "text")


def test_attach_system_prompt(frame):
    led = attach_system_prompt(frame([(1, 0, "user", "你好"), (1, 1, "assistant", "a"), (2, 0, "system", "s"), (2, 1, "user", "u"), (3, 0, "assistant", "alone")], CONV), TEMPLATES)
    assert bag_of(led.filter("turn = -1").select("conv_id", "role", "text")) == [(1, "system", "ZH")]
    assert led.count() == 6


def test_render_prompt(frame):
    df = frame([(1, 0, "user", "hi"), (1, 1, "tool", "x"), (1, 2, "assistant", "yo")], CONV)
    assert rows_of(render_prompt(df), "prompt") == ["<|user|>\nhi\n\n<|assistant|>\nyo\n\n<|assistant|>"]


def test_trim_history(frame):
    assert texts_of(trim_history(talk(frame, "S", "u1", "a1", "u2", "a2", "u3"), 1)) == ["S", "u2", "a2", "u3"]
    assert texts_of(trim_history(talk(frame, "S", "u1", "u2"), 1)) == ["S", "u1", "u2"]


def test_prompt_at_turn(frame):
    prompts = rows_of(prompt_at_turn(talk(frame, "S", "u1", "a1", "u2", "a2", "u3"), 1).orderBy("turn"), "turn", "prompt")
    shown = [(t, [line for line in p.split("\n") if line and line[0] != "<"]) for t, p in prompts]
    assert shown == [(1, ["S", "u1"]), (3, ["S", "u1", "a1", "u2"]), (5, ["S", "u2", "a2", "u3"])]


def test_segments(frame):
    df = frame(
        [(1, 0, "system", "S"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "Clear "), (1, 4, "user", "u2"), (1, 5, "assistant", "reset")],
        CONV,
    )
    assert texts_of(segment_on_reset(df), "segment") == [(0, "S"), (0, "u1"), (0, "a1"), (1, "S"), (1, "u2"), (1, "reset")]


def test_exit(frame):
    assert texts_of(cut_at_exit(talk(frame, "u1", "a1", "EXIT", "u2"))) == ["u1", "a1"]


# --- chunks -------------------------------------------------------------------------------------------


def stream(frame, *contents, at=None):
    rows = [("s", i, float(at[i]) if at else float(i), c) for i, c in enumerate(contents)]
    return frame(rows, "stream_id string, chunk_idx int, at double, content string").withColumn("ts", F.timestamp_seconds("at"))


def contents_of(df):
    return rows_of(df.orderBy("chunk_idx"), "content")


def test_own_chunkers(frame):
    df = frame([(1, "ab((c)d)e", "x"), (2, None, "y"), (3, "", "z")], "id int, text string, other string")

    def balanced(text):
        """Cuts where no bracket is open."""
        depth, start = 0, 0
        for at, c in enumerate(text):
            depth += (c == "(") - (c == ")")
            if depth == 0:
                yield text[start : at + 1]
                start = at + 1
        yield text[start:] or None

    chunks = chunk_with(df, balanced)
    assert chunks.columns == ["id", "other", "chunk_idx", "content"]
    assert sorted(rows_of(chunks, "id", "chunk_idx", "content")) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "((c)d)"), (1, 3, "e")]
    twice = chunk_with(df, lambda t: ["", t], keep=["id"])
    assert sorted(rows_of(twice, "id", "chunk_idx", "content")) == [(1, 0, ""), (1, 1, "ab((c)d)e"), (3, 0, ""), (3, 1, "")]
    assert chunk_with(df.limit(0), balanced).count() == 0
    assert "Exchange" not in chunks._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        chunk_with(df, balanced, content="other")
    with pytest.raises(Exception, match="not a string"):
        chunk_with(df, lambda t: [1]).collect()


def test_repetition_guard(frame):
    assert contents_of(repetition_guard(stream(frame, *"ababc"), 4)) == ["a", "b", "a"]
    assert contents_of(repetition_guard(stream(frame, "ab", "c", "a", "bc"), 4)) == ["ab", "c", "a"]
    with pytest.raises(ValueError):
        repetition_guard(stream(frame, "a"), 3)


def test_budget_guard(frame):
    assert contents_of(budget_guard(stream(frame, *"abcde"), 3)) == ["a", "b", "c"]
    assert contents_of(budget_guard(stream(frame, *"abc", at=[0, 10, 11]), 9, 10)) == ["a", "b"]
    stops = budget_stops(stream(frame, *"abcde"), 3)
    assert rows_of(stops, "kept", "stop_reason") == [(3, "max_tokens")]
    assert rows_of(budget_stops(stream(frame, "a")), "kept", "stop_reason") == [(1, None)]


def test_sentinel(frame):
    assert contents_of(take_until_sentinel(stream(frame, "x", "", "||END||", "y"))) == ["x"]


def test_suppress_think(frame):
    chunks = stream(frame, "A", "<think>", "x", "</think>", "B", "c<think></think>d", "E")
    assert contents_of(suppress_think(chunks)) == ["A", "\n", "B"]


def test_rechunk(frame):
    for bounded in (True, False):
        assert contents_of(rechunk(stream(frame, "ab", "cd", "e", "fghijk", "l"), bounded=bounded)) == ["abcde", "fghijk", "l"]


def test_chunk_and_assemble(frame):
    texts = [(1, " a  b\nc d "), (2, "x"), (3, "")]
    chunks = chunk_text(frame(texts, "stream_id int, text string"), last="is_last")
    assert chunks.filter("is_last").count() == 2
    assert dict(rows_of(assemble_text(chunks), "stream_id", "text")) == {1: "a  b\nc d", 2: "x"}


def test_reply_metrics(frame):
    metrics = reply_metrics(stream(frame, "Hel", "lo you", at=[1, 3.5]))
    assert rows_of(metrics, "elapsed", "n_chunks", "n_tokens") == [(2.5, 2, 2)]


# --- long texts, sessions, batches, assets ------------------------------------------------------------


def test_segment_ids(frame):
    df = frame([(7, "One. Two! Three?", 0)], "doc_id bigint, text string, t bigint")
    out = segment_ids(df, "doc_id", F.timestamp_seconds("t"), limit=8)
    assert rows_of(out.orderBy("seg_no"), "name", "text", "stamp") == [
        ("8f14e45f_seg000", "One. Two!", "19700101_000000"),
        ("8f14e45f_seg001", "Three?", "19700101_000000"),
    ]


def test_idle_sessions(frame):
    df = frame([(1, i, t) for i, t in enumerate([0, 600, 1201])], "user_id int, event_id int, t bigint").withColumn("ts", F.timestamp_seconds("t"))
    assert rows_of(idle_sessions(df).orderBy("t"), "session") == [0, 0, 1]


def test_batch_plan(frame):
    plan = batch_plan(frame([(i,) for i in range(5)], "id int"), "id", epochs=2, per_device=2, accumulate=2)
    for epoch in (0, 1):
        got = rows_of(plan.filter(F.col("epoch") == epoch).orderBy("rn"), "rn", "micro_batch", "step")
        assert got == [(0, 0, 0), (1, 0, 0), (2, 1, 0), (3, 1, 0), (4, 2, 1)]
    assert plan.groupBy("epoch", "id").count().filter("count != 1").isEmpty()


def test_retention(frame):
    files = frame([("a.WAV", 1), ("b.wav", 2), ("c.txt", 3)], "path string, m bigint").withColumn("modificationTime", F.timestamp_seconds("m"))
    assert rows_of(newest(files, 2).orderBy("path"), "path") == ["b.wav", "c.txt"]
    assert rows_of(stale(files, 2), "path") == ["a.WAV"]
    aged = frame([("a.WAV", 9999 - 3600), ("b.WAV", 9999 - 3601), ("c.txt", 0)], "path string, m bigint").withColumn("modificationTime", F.timestamp_seconds("m"))
    assert rows_of(expired(aged, F.timestamp_seconds(F.lit(9999))), "path") == ["b.WAV"]


def test_classify_listing(frame):
    df = frame([(1, "a.txt"), (1, "m-GGML.bin"), (2, "a.txt"), (3, None)], "g int, name string")
    assert dict(rows_of(classify_listing(df, ["g"], "name"), "g", "label")) == {1: "gguf", 2: "hf", 3: "hf"}


# --- tokens -------------------------------------------------------------------------------------------

VOCAB = [("<pad>", 0, True), ("</s>", 1, True), ("<unk>", 2, True), ("a", 3, False), ("b", 4, False)]


@pytest.mark.parametrize(
    "max_len, ids, mask, labels",
    [(5, [3, 4, 2, 0, 0], [1, 1, 1, 0, 0], [3, 4, 2, -100, -100]), (2, [3, 4], [1, 1], [3, 4])],
)
def test_encode(frame, max_len, ids, mask, labels):
    vocab = frame(VOCAB, "token string, token_id int, is_special boolean")
    encoded = encode(frame([(1, "a b c"), (2, "")], "doc_id int, text string"), vocab, max_len, 2, pattern=r"\w+")
    rows = {r["doc_id"]: r for r in training_arrays(encoded, max_len, 0).collect()}
    assert (rows[1]["input_ids"], rows[1]["attention_mask"], rows[1]["labels"]) == (ids, mask, labels)
    assert rows[2]["attention_mask"] == [0] * max_len


def test_decode(frame):
    vocab = frame(VOCAB, "token string, token_id int, is_special boolean")
    assert rows_of(decode(frame([(1, [3, 4, 2, 0, 0])], "doc_id int, input_ids array<int>"), vocab), "text") == ["ab"]


def test_round_trip(frame):
    docs = frame([(1, "One word, two words."), (2, "two\n\nlines  here")], "doc_id int, text string")
    vocab = build_vocab(docs, 100)
    back = decode(encode(docs, vocab, 100, 2), vocab)
    assert bag_of(back) == bag_of(docs)


# --- user functions and stages ------------------------------------------------------------------------


def test_row_and_batch_functions(frame):
    df = frame([(1, "x"), (2, "yy")], "id int, text string")
    assert rows_of(map_rows(df, lambda r: {"text": r["text"] * 2, "n": len(r["text"])}, "text string, n int"), "id", "text", "n") == [(1, "xx", 1), (2, "yyyy", 2)]
    out = map_batches(df, lambda b: b[["text"]].assign(n=b["text"].str.len())[["n"]], "n bigint", remove=["text"])
    assert out.columns == ["id", "n"] and rows_of(out, "id", "n") == [(1, 1), (2, 2)]


def test_fallbacks(frame):
    df = frame([("1",), ("x",), ("3",)], "v string")
    cast = value_or(F.col("v").try_cast("int"), F.lit(0))
    out = with_fallback(df, lambda d: d.select("missing"), lambda d: d.select(cast.alias("n")))
    assert rows_of(out, "n") == [1, 0, 3]


def test_stages(spark):
    def fail(values):
        raise ValueError("no data")

    log = run_stages([("ingest", lambda v: None), ("render", fail), ("arrays", lambda v: None)]).report(spark)
    assert rows_of(log.orderBy("position"), "status") == ["done", "stopped", "skipped"]
    short = run_stages([("ingest", lambda v: None), ("render", fail)], ingest_only=True).report(spark)
    assert rows_of(short.orderBy("position"), "status") == ["done", "skipped"]
