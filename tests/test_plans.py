"""What the physical plans must and must not contain."""

import glob
import os

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from checks import QUERIES, SQL
from corpusloom.operators.batching import batch_plan
from corpusloom.operators.conversations import attach_system_prompt, trim_history
from corpusloom.operators.instruct import render_instruction
from corpusloom.operators.retention import newest, stale
from corpusloom.operators.segments import segments
from corpusloom.operators.sessions import idle_sessions
from corpusloom.plans.ordered import with_runs
from corpusloom.plans.prompts import conversation_prompts
from tools.compare import bag


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


STREAMS = {n for n in QUERIES if n.startswith("k")}
# user functions, and the automaton of rule tables; the joined form of the same rules has no Python
PYTHON = {"u1_map_rows", "u2_map_batches", "u4_own_chunker", "j2_rules_from_table", "j3_listing_from_table", "j5_triage_from_table"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    """The rows of the SQL; outside the Python operators no Python node, and never a cross join."""
    df = QUERIES[name](spark, SF)
    text = plan(df)
    forbidden = ["CartesianProduct", "BroadcastNestedLoopJoin"]
    if name not in STREAMS | PYTHON:
        forbidden += ["Python", "Arrow", "Pandas"]
    assert not [node for node in forbidden if node in text]
    expected = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert bag(df.collect(), df.columns) == bag(expected.fetchall(), expected.columns)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_batch_plan_is_not_sorted_in_one_task(spark):
    assert "SinglePartition" not in plan(batch_plan(read(spark, "documents"), "doc_id"))


def test_row_local_work_does_not_shuffle(spark):
    docs = read(spark, "documents").select("doc_id", "text")
    assert "Exchange" not in plan(segments(docs))
    assert "Exchange" not in plan(render_instruction(docs))


def test_columns_are_pruned(spark):
    text = plan(render_instruction(read(spark, "documents").select("doc_id", "text")).select("doc_id"))
    assert "text" not in text.split("ReadSchema")[1]


def test_top_rows_are_cut_before_the_shuffle(spark):
    events = read(spark, "events")
    grouped = plan(newest(events, 3, ["event_type"], "ts", "event_id"))
    assert grouped.index("WindowGroupLimit") < grouped.index("Exchange") and grouped.count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(newest(events, 3, (), "ts", "event_id"))
    assert "SinglePartition" not in plan(stale(events, 3, ["event_type"], "ts", "event_id"))


def test_system_prompts_need_no_join(spark):
    assert "Join" not in plan(attach_system_prompt(read(spark, "conversations"), {"en": "EN"}))


def test_split_filter_prunes_folders(spark, tmp_path):
    from corpusloom.sources.catalog import read_saved, save_dataset, select_split

    path = str(tmp_path / "saved")
    save_dataset(read(spark, "documents").withColumn("split", F.when(F.col("lang") == "en", "train").otherwise("test")), path, "split")
    text = plan(select_split(read_saved(spark, [path])[0], ["test", "train"]))
    assert "PartitionFilters: [isnotnull(split" in text


def count_of_runs(df):
    """Scans of the written runs in a plan, and shuffles by key."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("/runs-"), plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")


def test_a_chain_over_a_hot_key_scans_it_a_few_times(spark):
    rows = [(1, t, "user" if t % 2 else "assistant", f"m{t}") for t in range(400)] + [(c, t, "user", "x") for c in range(2, 30) for t in range(4)]
    conv = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    # exit, reset, system row, numbers, replies, and the join of prompts with messages: each side of it scans once per size of key
    scans, shuffles = count_of_runs(conversation_prompts(conv, {"en": "EN"}, split_above=32))
    assert scans <= 4 and shuffles <= 7
    scans, shuffles = count_of_runs(trim_history(with_runs(conv, ["conv_id"], ["turn"], 32)))
    assert scans <= 1 and shuffles <= 1
    events = conv.withColumn("ts", F.timestamp_seconds("turn"))
    scans, shuffles = count_of_runs(idle_sessions(with_runs(events, ["conv_id"], ["ts"], 32), 600, ["conv_id"], "ts", []))
    assert scans <= 1 and shuffles <= 1


def test_no_table_is_written_for_hot_keys_where_there_are_none(spark, monkeypatch):
    from corpusloom.plans import ordered

    monkeypatch.setattr(ordered, "materialize", lambda *_: pytest.fail("a table was written"))
    conv = spark.createDataFrame([(1, 1)], "conv_id int, turn int")
    assert not ordered.is_split(with_runs(conv, ["conv_id"], ["turn"]))


def test_no_epochs_are_no_rows(spark):
    assert batch_plan(spark.range(5), "id", epochs=0).count() == 0
    assert batch_plan(spark.range(5), "id", epochs=2).count() == 10


def test_documents_are_assembled_where_they_are_cut(spark):
    """The texts are shuffled once, and none of their chunks."""
    lines = plan(QUERIES["e2_assemble_documents"](spark, SF)).split("\n")
    cut = next(k for k, line in enumerate(lines) if "Generate" in line)
    assert not [line for line in lines[:cut] if "Exchange" in line]
    assert len([line for line in lines if "Exchange" in line]) == 1
