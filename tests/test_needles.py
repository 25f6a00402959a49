"""Rules from a table against a plain search of every needle in every text."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.operators import needles
from corpusloom.operators.needles import Automaton, classify_by_table, classify_listing_by_table, mark_rules

RULES = "needle string, priority long, label string"
FORMS = {"automaton": {}, "join": {"max_needles": 0}}


def brute(texts, rules, ignore_case):
    def low(s):
        return s.lower() if ignore_case else s

    usable = [(p, name, low(n)) for n, p, name in rules if n and p is not None and name is not None]
    return [min(((p, name) for p, name, n in usable if n in low(t or "")), default=None) for t in texts]


def cases():
    rng = random.Random(5)
    letters = "abAB é漢😀\n"
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(120)]
    texts += [None, "", "a" * 5000 + "BéB" + "a" * 700, "x" * 511 + "needle", "x" * 505 + "needle" + "y" * 1200]
    rules = [("".join(rng.choices(letters, k=rng.randint(1, 4))), rng.randint(0, 30), rng.choice("uvw")) for _ in range(60)]
    rules += [("needle", -3, "n"), ("needle", -3, "m"), ("a", 99, "a"), ("", -9, "never"), (None, -9, "never"), ("b", None, "never"), ("b", -9, None)]
    return texts, rules + rules[:5]


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("ignore_case", [True, False])
def test_same_as_plain_search(spark, form, ignore_case):
    texts, rules = cases()
    rows = [(k, text, "kept") for k, text in enumerate(texts)] * 2
    df = spark.createDataFrame(rows, "needle long, text string, _rule string")  # names that clash with those of rules
    out = mark_rules(df, "text", spark.createDataFrame(rules, RULES), ignore_case=ignore_case, **FORMS[form])
    assert out.columns == [*df.columns, "rule"]
    want = brute(texts, rules, ignore_case)
    found = out.collect()
    assert len(found) == len(rows) and {r["_rule"] for r in found} == {"kept"}
    for row in found:
        assert (tuple(row["rule"]) if row["rule"] else None) == want[row["needle"]]


@pytest.mark.parametrize("form", FORMS)
def test_empty_tables(spark, form):
    none = spark.createDataFrame([], RULES)
    df = spark.createDataFrame([("a",), (None,)], "label string")
    assert [r["label"] for r in classify_by_table(df, "label", none, "plain", **FORMS[form]).collect()] == ["plain"] * 2
    rules = spark.createDataFrame([("a", 1, "x")], RULES)
    assert classify_by_table(df.limit(0), "label", rules, **FORMS[form]).collect() == []


@pytest.mark.parametrize("form", FORMS)
def test_groups_take_their_first_rule(spark, form):
    names = spark.createDataFrame([(1, "cold ring"), (1, "RED ring"), (2, "ring"), (None, "hot"), (None, None)], "g int, name string")
    rules = spark.createDataFrame([("red", 0, "warm"), ("cold", 1, "cool"), ("hot", 2, "warm")], RULES)
    out = classify_listing_by_table(names, ["g"], "name", rules, "plain", **FORMS[form]).collect()
    assert {(r["g"], r["label"]) for r in out} == {(1, "warm"), (2, "plain"), (None, "warm")}


def test_one_scan_without_shuffle(spark, tmp_path):
    spark.range(1000).selectExpr("id", "repeat(cast(id as string), 20) AS text").write.parquet(str(tmp_path / "texts"))
    rules = spark.range(3000).selectExpr("cast(id * 7 as string) AS needle", "id AS priority", "'x' AS label")
    plan = mark_rules(spark.read.parquet(str(tmp_path / "texts")), "text", rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("ArrowEvalPython") == 1
    assert "Exchange" not in plan and "Join" not in plan


def test_lanes_and_pieces_change_nothing(monkeypatch):
    texts, rules = cases()
    data = [(t or "").encode() for t in texts]
    ends = np.cumsum([len(t) for t in data])
    used = [(n.encode(), p + 10) for n, p, name in rules if n and p is not None and name]
    automaton = Automaton([n for n, _ in used], [p for _, p in used])
    joined = np.frombuffer(b"".join(data), np.uint8)
    whole = automaton.smallest(joined, ends - [len(t) for t in data], ends)
    monkeypatch.setattr(needles, "LANES", 3)
    monkeypatch.setattr(needles, "PIECE", 2)
    assert (automaton.smallest(joined, ends - [len(t) for t in data], ends) == whole).all()
    assert whole.tolist() == [min((p for n, p in used if n in t), default=needles.NO_RULE) for t in data]


def test_the_join_looks_up_few_stretches(spark):
    """Not every stretch of text that is as long as some needle, and not the bits in every row."""
    texts = ["".join(random.Random(k).choices("abcdefghij", k=3000)) + "needle" * (k % 2) for k in range(20)]
    rules = spark.range(400).selectExpr("concat('need', id) AS needle", "id AS priority", "'x' AS label").union(
        spark.createDataFrame([("needle", 1, "y"), ("long " * 20, 2, "z")], RULES)
    )
    usable = needles.materialize(needles.usable_rules(rules, "needle", "priority", "label", False))
    lengths = sorted(r[0] for r in usable.selectExpr("char_length(needle)").distinct().collect())
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = needles._stretches(rows, usable, lengths)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "AS _bits" not in plan
    looked_up = [(r["id"], r["needle"]) for r in found.filter("needle IS NOT NULL").collect()]
    assert {(k, "needle") for k in range(1, 20, 2)} <= set(looked_up) and len(looked_up) < 1000


def test_short_texts_of_one_split_are_looked_up_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(needles, "TASK_BYTES", 1000)
    rows = spark.createDataFrame([(k, f"text {k} with abc in it") for k in range(1000)], "id long, text string").coalesce(1)
    rules = spark.createDataFrame([("abc",)], "needle string")
    found = needles._stretches(rows, rules, [3]).filter("needle = 'abc'").withColumn("task", F.spark_partition_id())
    held = [r["count"] for r in found.groupBy("task").count().collect()]
    assert sum(held) == 1000 and len(held) > 15 and max(held) < 100
