"""Hand-worked cases for the scalar functions."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions.arrays import attention_mask, last_n, mask_labels, pad_fallback, pad_truncate
from corpusloom.functions.rules import (
    ERROR_RULES,
    chunk_content,
    classify_by_rules,
    is_large,
    json_fields,
    model_family,
    size_from_name,
    triage_messages,
)
from corpusloom.functions.text import (
    WHITESPACE,
    count_tokens,
    detect_lang,
    fill_template,
    normalize_command,
    pack_segments,
    split_and_pack,
    split_sentences,
    strip,
    strip_think_text,
    suffix_of,
    to_billions,
    to_gib,
    tokens,
)
from corpusloom.operators.classify import classify_names


def value(frame, expr, v, kind="string"):
    return frame([(v,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text, lang", [("abc", "en"), ("a你", "zh"), (None, "en")])
def test_detect_lang(frame, text, lang):
    assert value(frame, detect_lang, text) == lang


@pytest.mark.parametrize(
    "text, pieces",
    [
        ("Hello! ok", ["Hello!", " ok"]),
        ("a!?  ", ["a!", "?"]),
        ("你好。再见！x", ["你好。", "再见！", "x"]),
        ("no punct.", ["no punct."]),
        ("", []),
        (None, []),
    ],
)
def test_split_sentences(frame, text, pieces):
    assert value(frame, split_sentences, text) == pieces


@pytest.mark.parametrize(
    "pieces, packed",
    [
        (["abc!", "defg!", "hi?", "0123456789ab;", "z"], ["abc!defg!", "hi?", "0123456789ab;", "z"]),
        (["abcde!", "fgh!"], ["abcde!", "fgh!"]),
        ([], []),
    ],
)
def test_pack_segments(frame, pieces, packed):
    assert value(frame, lambda c: pack_segments(c, 10), pieces, "array<string>") == packed


def greedy(pieces, limit):
    out, held = [], ""
    for piece in pieces:
        if len(held) + len(piece) < limit:
            held += piece
        else:
            if held:
                out.append(held)
            held = piece
    return out + [held] if held else out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text("ab!。", min_size=1, max_size=9), max_size=700), min_size=1, max_size=4))
def test_pack_segments_matches_a_loop(frame, lists):
    df = frame([(i, p) for i, p in enumerate(lists)], "i int, p array<string>")
    got = {r["i"]: r["s"] for r in df.select("i", pack_segments("p", 12).alias("s")).collect()}
    for i, pieces in enumerate(lists):
        assert got[i] == greedy(pieces, 12)
        assert all(len(s) < 12 or s in pieces for s in got[i])
        assert "".join(got[i]) == "".join(pieces)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab \n!。;\u3000🌙", max_size=120), min_size=1, max_size=8), st.sampled_from([1, 2, 5, 12, 30]))
def test_split_and_pack_is_split_then_pack(frame, texts, limit):
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", split_sentences("t").alias("p"), split_and_pack("t", limit).alias("s")).collect()
    for r in rows:
        loop = [p for p in re.findall("[^!。;]*[!。;]|[^!。;]+", texts[r["i"]]) if p.strip()]
        assert r["p"] == loop
        assert r["s"] == greedy(loop, limit)


def test_strip(frame):
    assert value(frame, normalize_command, "\t Clear \n") == "clear"
    padded = WHITESPACE + "a b" + WHITESPACE
    assert value(frame, strip, padded) == padded.strip() == "a b"


@pytest.mark.parametrize("path, suffix", [("a/b.tar.GZ", ".gz"), ("a.b/c", ""), ("x", "")])
def test_suffix_of(frame, path, suffix):
    assert value(frame, suffix_of, path) == suffix


@pytest.mark.parametrize("text, shown", [("ab<think>x\ny</think>z", "ab\nz"), ("ab<think>x", "ab"), ("ab", "ab")])
def test_strip_think_text(frame, text, shown):
    assert value(frame, strip_think_text, text) == shown


def test_tokens_lose_nothing(frame):
    text = "Hello, wörld!  it's\n\n a  test — 你好 🌙\t"
    assert "".join(value(frame, tokens, text)) == text
    assert value(frame, count_tokens, text) == len(value(frame, tokens, text))
    assert value(frame, count_tokens, None) == 0


def test_fill_template(frame):
    assert value(frame, lambda c: fill_template("<{a}|{b}>", a=c, b=F.lit(1)), "x") == "<x|1>"
    assert value(frame, lambda c: fill_template("<{a}>", a=c), None) == "<>"


def test_units(frame):
    assert value(frame, to_gib, 1610612736, "bigint") == 1.5
    assert value(frame, to_billions, 7_250_000_000, "bigint") == 7.3


def test_arrays(frame):
    ids = [3, 4, 2]
    kind = "array<int>"
    assert value(frame, lambda c: pad_truncate(c, 5, 0), ids, kind) == [3, 4, 2, 0, 0]
    assert value(frame, lambda c: pad_truncate(c, 5, 0, "left"), ids, kind) == [0, 0, 3, 4, 2]
    assert value(frame, lambda c: pad_truncate(c, 2, 0), ids, kind) == [3, 4]
    assert value(frame, lambda c: attention_mask(c, 5), ids, kind) == [1, 1, 1, 0, 0]
    assert value(frame, lambda c: attention_mask(c, 2), ids, kind) == [1, 1]
    assert value(frame, lambda c: attention_mask(c, 3), [0, 3], kind) == [1, 1, 0]
    assert value(frame, lambda c: mask_labels(c, 0), [3, 4, 2, 0, 0], kind) == [3, 4, 2, -100, -100]
    assert value(frame, lambda c: last_n(c, 2), [1, 2, 3], kind) == [2, 3]
    assert value(frame, lambda c: last_n(c, 2), [1], kind) == [1]
    assert value(frame, lambda c: last_n(c, 2), [], kind) == []
    assert value(frame, lambda c: pad_fallback(c, F.lit("</s>")), None) == "</s>"


def test_json(frame):
    paths = {"architecture": "$.architectures[0]"}
    assert value(frame, lambda c: json_fields(c, paths), '{"architectures":["X"]}')[0] == "X"
    assert value(frame, lambda c: json_fields(c, paths), "bad")[0] is None
    assert value(frame, chunk_content, '{"choices":[{"delta":{"content":"x"}}]}') == "x"
    assert value(frame, chunk_content, '{"choices":[]}') is None


@pytest.mark.parametrize(
    "name, family", [("BitNetLlama", "bitnet"), ("QwenMoe", "moe"), ("GPT-NeoX", "moe"), ("gpt2", "gpt"), ("Other", "hf"), (None, "hf")]
)
def test_classify(frame, name, family):
    assert value(frame, classify_by_rules, name) == family


def test_family_override(frame):
    assert value(frame, lambda c: model_family(c, F.lit("x")), "MixtureLlama") == "moe"
    assert value(frame, lambda c: model_family(c, F.lit("bitnet-b1")), "Llama") == "bitnet"


@pytest.mark.parametrize("names, label", [(["a.txt", "m-GGML.bin"], "gguf"), (["a.txt"], "hf"), (None, "hf")])
def test_classify_names(frame, names, label):
    assert value(frame, classify_names, names, "array<string>") == label


def test_sizes(frame):
    assert value(frame, size_from_name, "qwen-x-1.5b") == 1.5e9
    assert value(frame, size_from_name, "x") == 0
    assert value(frame, size_from_name, "x-7b") == 0
    assert value(frame, lambda c: size_from_name(c, only_with=""), "x-7b") == 7e9
    assert value(frame, size_from_name, "Qwen-72b") == 72e9
    assert value(frame, lambda c: size_from_name(F.lit("qwen-7b"), c), 12e9, "double") == 12e9
    assert value(frame, lambda c: size_from_name(F.lit("qwen-7b"), c), 0.0, "double") == 7e9
    assert value(frame, is_large, 12e9, "double") is True
    assert value(frame, is_large, 1.5e9, "double") is False


def test_triage(frame):
    found = value(frame, triage_messages, "CUDA out of memory. Tried to allocate")
    assert found["category"] == ERROR_RULES[0][1] and found["detail"].startswith("CUDA")
    assert value(frame, triage_messages, "something else")["category"] == "load_failed"
