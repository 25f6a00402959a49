"""Catalog, splits, concatenation, stages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query, table
from corpusloom.operators.concat import concat_datasets, concat_or_first, count_by_source
from corpusloom.operators.instruct import non_empty, require_columns
from corpusloom.plans.spread import parts_of
from corpusloom.plans.stages import TrainingSetConfig, run_stages, training_set_stages
from corpusloom.session import scratch_path
from corpusloom.sources.catalog import (
    Source,
    file_report,
    load_catalog,
    load_readable,
    load_with_report,
    read_in_order,
    read_saved,
    save_dataset,
    select_split,
)

NAMES = ("documents", "benchmark", "pages")
# Bytes of text that one task sorts and writes as one file.
FILE_BYTES = 64 << 20


def _catalog(sf_dir: str) -> list[Source]:
    return [Source(name, f"{sf_dir}/{name}.parquet") for name in NAMES]


@query(
    """SELECT 'documents' AS source, count(*) AS n FROM documents
       UNION ALL SELECT 'benchmark', count(*) FROM benchmark
       UNION ALL SELECT 'pages', count(*) FROM pages"""
)
def a1_load_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = load_catalog(spark, _catalog(sf_dir))
    return count_by_source(concat_datasets(list(tables.values()), order_column=None))


SPLIT_SQL = "CASE source WHEN 'src0' THEN 'train' WHEN 'src1' THEN 'validation' ELSE 'test' END"


def _with_split(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "split", F.when(F.col("source") == "src0", "train").when(F.col("source") == "src1", "validation").otherwise("test")
    )


@query(f"SELECT doc_id, text, lang, source, n_chars, {SPLIT_SQL} AS split FROM documents")
def a2_save_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "saved")
    save_dataset(_with_split(table(spark, sf_dir, "documents")), path, split="split")
    return read_saved(spark, [path])[0]


@query("SELECT doc_id, text, source FROM documents")
def a3_read_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_saved(spark, [f"{sf_dir}/no_such_table.parquet", f"{sf_dir}/documents.parquet"])
    return concat_datasets(found, order_column=None).select("doc_id", "text", "source")


@query(
    """SELECT 'documents' AS source, 'loaded' AS status, count(*) AS n FROM documents
       UNION ALL SELECT 'benchmark', 'loaded', count(*) FROM benchmark
       UNION ALL SELECT 'gone', 'missing', NULL
       UNION ALL SELECT 'broken', 'failed', NULL"""
)
def a4_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = [
        Source("documents", f"{sf_dir}/documents.parquet"),
        Source("gone", f"{sf_dir}/no_such_table.parquet"),
        Source("broken", f"{sf_dir}/pages.parquet", prepare=lambda df: df.select("no_such_column")),
        Source("benchmark", f"{sf_dir}/benchmark.parquet"),
    ]
    return load_with_report(spark, catalog)[1].select("source", "status", F.col("rows").alias("n"))


def _with_a_broken_file(spark: SparkSession, sf_dir: str) -> Source:
    """Documents by split, and beside them a file that is no Parquet."""
    path = scratch_path(spark, "files")
    save_dataset(_with_split(table(spark, sf_dir, "documents")), path, split="split")
    table(spark, sf_dir, "documents").limit(1).select("text").coalesce(1).write.text(f"{path}/split=broken")
    return Source("documents", path)


@query(
    """SELECT 'loaded' AS status, count(*) AS n_rows, false AS has_error FROM documents
       UNION ALL SELECT 'failed', NULL, true"""
)
def a4_file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = file_report(spark, _with_a_broken_file(spark, sf_dir))
    return report.groupBy("status").agg(F.sum("rows").alias("n_rows"), F.max(F.col("error").isNotNull()).alias("has_error"))


@query(f"SELECT doc_id, text, {SPLIT_SQL} AS split FROM documents")
def a4_load_readable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_readable(spark, _with_a_broken_file(spark, sf_dir))[0].select("doc_id", "text", "split")


@query(
    """SELECT 0 AS source_ord, row_number() OVER (ORDER BY doc_id) - 1 AS position, 'd' || doc_id AS example, text FROM documents
       UNION ALL SELECT 1, row_number() OVER (ORDER BY item_id) - 1, 'b' || item_id, text FROM benchmark
       UNION ALL SELECT 2, row_number() OVER (ORDER BY page_id) - 1, 'p' || page_id, url FROM pages"""
)
def c1_ordered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = lambda letter, key, text: lambda df: df.select("position", F.concat(F.lit(letter), key).alias("example"), F.col(text).alias("text"))
    # the tables are written in the order of their keys, in five files or more of a bounded size, so that the order is known
    sources = []
    for name, letter, key, text in (("documents", "d", "doc_id", "text"), ("benchmark", "b", "item_id", "text"), ("pages", "p", "page_id", "url")):
        path = scratch_path(spark, f"ordered-{name}")
        rows = table(spark, sf_dir, name).select(key, text)
        files = parts_of(rows, F.octet_length(text), least=5, max_bytes=FILE_BYTES)
        save_dataset(rows.repartitionByRange(files, key).sortWithinPartitions(key), path)
        sources.append(Source(name, path, prepare=keyed(letter, key, text)))
    return concat_datasets(read_in_order(spark, sources), order_column=None).drop("source")


@query(
    """SELECT 'train' AS chosen, doc_id, n_chars FROM documents WHERE source = 'src0'
       UNION ALL SELECT 'first', doc_id, n_chars FROM documents WHERE lang = 'fr'
       UNION ALL SELECT 'whole', doc_id, n_chars FROM documents"""
)
def a5_select_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cols = ["doc_id", "n_chars"]
    preferred = select_split(_with_split(docs), ["test", "train", "validation"]).select(F.lit("train").alias("chosen"), *cols)
    first = select_split(docs, ["fr", "en"], column="lang").select(F.lit("first").alias("chosen"), *cols)
    whole = select_split(docs, []).select(F.lit("whole").alias("chosen"), *cols)
    return preferred.unionByName(first).unionByName(whole)


@query(
    """SELECT 0 AS position, 'ingest' AS stage, 'done' AS status, NULL AS rows_out
       UNION ALL SELECT 1, 'render', 'done', NULL
       UNION ALL SELECT 2, 'arrays', 'done', (SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark)
       UNION ALL SELECT 3, 'batches', 'done', 3 * ((SELECT count(*) FROM documents) + (SELECT count(*) FROM benchmark))"""
)
def a7_run_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = lambda name: lambda df: df.select(F.col(name).alias("example_id"), "text")
    out = scratch_path(spark, "training-set")
    cfg = TrainingSetConfig(
        catalog=[
            Source("documents", f"{sf_dir}/documents.parquet", prepare=keyed("doc_id")),
            Source("benchmark", f"{sf_dir}/benchmark.parquet", prepare=keyed("item_id")),
        ],
        out_path=out,
        vocab_size=5000,
        max_len=512,
    )
    log = run_stages(training_set_stages(spark, cfg)).report(spark).select("position", "stage", "status")
    written = spark.read.parquet(f"{out}/arrays").agg(F.count(F.lit(1)).alias("rows_out")).select(F.lit("arrays").alias("stage"), "rows_out")
    planned = spark.read.parquet(f"{out}/batches").agg(F.count(F.lit(1)).alias("rows_out")).select(F.lit("batches").alias("stage"), "rows_out")
    return log.join(written.unionByName(planned), "stage", "left").select("position", "stage", "status", "rows_out")


@query("SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
def b1_require_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = require_columns(table(spark, sf_dir, "documents"), ("doc_id", "text"))
    return docs.select("doc_id", F.length("text").alias("n"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def b10_non_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_source(non_empty(table(spark, sf_dir, "documents")))


_CONCAT_SQL = """
SELECT 0 AS source_ord, doc_id, text, lang, NULL AS item_id, NULL AS conv_id, NULL AS turn, NULL AS role FROM documents
UNION ALL SELECT 1, NULL, text, NULL, item_id, NULL, NULL, NULL FROM benchmark
UNION ALL SELECT 2, NULL, text, NULL, NULL, conv_id, turn, role FROM conversations"""


@query(_CONCAT_SQL)
def c1_concat_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_datasets(
        [
            table(spark, sf_dir, "documents").select("doc_id", "text", "lang"),
            table(spark, sf_dir, "benchmark"),
            table(spark, sf_dir, "conversations"),
        ]
    )


@query("SELECT 0 AS source_ord, doc_id, text FROM documents")
def c2_concat_or_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clash = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("doc_id"), "text")
    return concat_or_first([docs, clash])[0]


@query(
    """SELECT source, count(*) AS n FROM (SELECT source FROM documents UNION ALL SELECT 'benchmark' FROM benchmark)
       GROUP BY source"""
)
def e1_count_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", "source")
    return count_by_source(concat_datasets([docs, table(spark, sf_dir, "benchmark").select("text", F.lit("benchmark").alias("source"))]))
