"""The training-data pipeline: from raw documents to packed sequences.

Each stage reads what the one before has kept, written as Parquet in between. The first four return the columns
of ``documents``; the last returns the pieces of the packed sequences.

1. toxicity: documents that the clause grammar, learned from the labels of its input, predicts toxic go;
2. near_dedup: of every group of near-duplicates the document with the smallest doc_id stays;
3. decontamination: documents that the contamination rule finds in the benchmark go;
4. secrets: secrets in the texts become ``<secret>``, n_chars follows; no document goes;
5. packing: all texts as tokens in as few sequences of 2048 as can be.

Null texts and ids, empty tables and repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import contamination, neardup, packing, secrets_scan, toxicity
from corpusloom.llm.common import materialize
from corpusloom.llm.queries import table, tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets_scan.redacted(docs)


def pack_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_texts),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
