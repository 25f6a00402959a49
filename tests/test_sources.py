"""Catalogs, splits, listings, whole runs."""

import pytest
from conftest import SF, bag_of, rows_of
from pyspark.sql import functions as F

from corpusloom.operators.retention import first_asset
from corpusloom.plans.stages import TrainingSetConfig, run_stages, training_set_stages
from corpusloom.session import scratch_path
from corpusloom.sources.assets import list_assets
from corpusloom.sources.catalog import (
    Source,
    choose_split,
    file_report,
    load_readable,
    load_with_report,
    read_in_order,
    read_saved,
    save_dataset,
    select_split,
)


def test_choose_split(frame):
    assert choose_split(["test", "train"]) == "train"
    assert choose_split(["dev", "test"]) == "dev"
    assert choose_split([]) is None
    df = frame([("a", "dev"), ("b", "test")], "text string, split string")
    assert rows_of(select_split(df, ["dev", "test"]), "text") == ["a"]
    assert select_split(df, []).count() == 2


def test_save_and_read(spark, frame, tmp_path):
    df = frame([("a", "dev"), ("b", "test")], "text string, split string")
    path = str(tmp_path / "x")
    save_dataset(df, path, "split")
    found = read_saved(spark, [str(tmp_path / "gone"), path])
    assert len(found) == 1 and bag_of(found[0]) == bag_of(df)


def test_report_goes_on_after_a_failure(spark, tmp_path):
    (tmp_path / "bad.parquet").write_text("not parquet")
    catalog = [
        Source("bad", str(tmp_path / "bad.parquet")),
        Source("gone", str(tmp_path / "gone")),
        Source("nation", f"{SF}/nation.parquet"),
    ]
    tables, report = load_with_report(spark, catalog)
    assert list(tables) == ["nation"]
    rows = {r["source"]: r for r in report.collect()}
    assert [rows[n]["status"] for n in ("bad", "gone", "nation")] == ["failed", "missing", "loaded"]
    assert rows["nation"]["rows"] == 25 and rows["bad"]["error"]


def files_of(spark, path, n=4, rows=4000):
    """Files of Spark's writer with incompressible texts, by name."""
    df = spark.range(rows).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    df.repartitionByRange(n, "id").write.parquet(str(path))
    return sorted(path.glob("*.parquet"))


def damaged(spark, path):
    """Four files: whole, cut short, with a flipped byte in a page, and whole."""
    files = files_of(spark, path)
    body = files[1].read_bytes()
    files[1].write_bytes(body[: len(body) // 2])
    body = bytearray(files[2].read_bytes())
    body[len(body) // 2] ^= 0x55
    files[2].write_bytes(bytes(body))
    for sums in path.glob(".*.crc"):  # the file system's own checksums are not what is tested
        sums.unlink()
    return files


def test_damage_is_told_per_file(spark, tmp_path):
    files = damaged(spark, tmp_path / "x")
    source = Source("x", str(tmp_path / "x"))
    rows = {r["file"].rsplit("/", 1)[1]: r for r in file_report(spark, source).collect()}
    assert [rows[f.name]["status"] for f in files] == ["loaded", "failed", "failed", "loaded"]
    assert all((rows[f.name]["rows"] is None) == (rows[f.name]["status"] == "failed") == bool(rows[f.name]["error"]) for f in files)
    df, report = load_readable(spark, source)
    assert report.count() == 4 and df.count() == sum(r["rows"] or 0 for r in rows.values())
    assert df.agg(F.sum(F.length("text"))).first()[0] == 128 * df.count()


def test_no_file_is_whole(spark, tmp_path):
    folder = tmp_path / "x"
    folder.mkdir()
    (folder / "a.parquet").write_text("no parquet")
    df, report = load_readable(spark, Source("x", str(folder)))
    assert df is None and [r["status"] for r in report.collect()] == ["failed"]


def test_one_whole_file_and_odd_columns(spark, tmp_path):
    path = str(tmp_path / "x")
    df = spark.createDataFrame([({"a": 1}, [{"b": 2}], None), (None, None, 1)], "`a.b` map<string,int>, l array<map<string,int>>, file int")
    df.coalesce(1).write.parquet(path)
    found, report = load_readable(spark, Source("x", path))
    assert found.count() == 2 and [(r["status"], r["rows"]) for r in report.collect()] == [("loaded", 2)]
    single = load_readable(spark, Source("nation", f"{SF}/nation.parquet"))
    assert single[0].count() == 25 and single[1].first()["error"] is None


def test_rows_in_order(spark, tmp_path):
    for name in ("a", "b"):
        files_of(spark, tmp_path / name, 5, 1000)
    tables = read_in_order(spark, [Source(n, str(tmp_path / n)) for n in ("a", "b")])
    assert [t.filter("position = id").count() for t in tables] == [1000, 1000]
    assert [t.select("source_ord", "source").distinct().collect()[0][:] for t in tables] == [(0, "a"), (1, "b")]
    assert "RoundRobin" not in tables[0]._jdf.queryExecution().executedPlan().toString()


def test_list_assets(spark, tmp_path):
    for name in ("b.PNG", "a.jpg", "c.txt", "d.webp.bak"):
        (tmp_path / name).write_bytes(b"x")
    files = list_assets(spark, str(tmp_path))
    names = sorted(p.rsplit("/", 1)[1] for p in rows_of(files, "path"))
    assert names == ["a.jpg", "b.PNG"]
    assert rows_of(first_asset(files), "path")[0].endswith("a.jpg")
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]


def config(spark, path, **changes):
    prepare = lambda df: df.select(F.col("item_id").alias("example_id"), "text")
    settings = dict(catalog=[Source("bench", path, prepare=prepare)], out_path=scratch_path(spark, "run"), vocab_size=50, max_len=8)
    return TrainingSetConfig(**{**settings, **changes})


def test_training_set(spark):
    cfg = config(spark, f"{SF}/benchmark.parquet")
    log = run_stages(training_set_stages(spark, cfg)).log
    assert [s for _, _, s, _ in log] == ["done"] * 4, log
    arrays = spark.read.parquet(f"{cfg.out_path}/arrays")
    assert arrays.count() == 40
    assert arrays.filter("size(input_ids) = 8 and size(labels) = 8 and size(attention_mask) = 8").count() == 40
    assert spark.read.parquet(f"{cfg.out_path}/batches").count() == 120


def test_a_missing_source_stops_a_strict_run(spark):
    log = run_stages(training_set_stages(spark, config(spark, "/no/such/path"))).log
    assert [s for _, _, s, _ in log] == ["stopped", "skipped", "skipped", "skipped"]


@pytest.mark.parametrize("name", ["conversation_prompts_all_turns"])
def test_entry(spark, name):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
