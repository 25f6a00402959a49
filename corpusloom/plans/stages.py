"""Ordered stages that stop at the first failing one."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.batching import batch_plan
from corpusloom.operators.concat import concat_or_first
from corpusloom.operators.instruct import non_empty, render_instruction, require_columns
from corpusloom.operators.tokens import build_vocab, encode, training_arrays
from corpusloom.session import materialize
from corpusloom.sources.catalog import LOADED, Source, load_with_report, save_dataset, select_split

STAGE_SCHEMA = "position int, stage string, status string, detail string"
DONE, STOPPED, SKIPPED = "done", "stopped", "skipped"
INGEST = "ingest"


class StageFailed(RuntimeError):
    """Raised by a stage that must end the run."""


@dataclass
class StageRun:
    """What the stages hand on, and what became of them."""

    values: dict[str, Any] = field(default_factory=dict)
    log: list[tuple[int, str, str, str | None]] = field(default_factory=list)

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.log, STAGE_SCHEMA)


def run_stages(
    stages: Sequence[tuple[str, Callable[[dict[str, Any]], str | None]]], ingest_only: bool = False
) -> StageRun:
    """Run the stages in order; after a failure, or after the ingest stage if asked, the rest is skipped."""
    run = StageRun()
    ended = False
    for position, (name, stage) in enumerate(stages):
        if ended:
            run.log.append((position, name, SKIPPED, None))
            continue
        try:
            run.log.append((position, name, DONE, stage(run.values)))
        except Exception as error:  # the report is the result of a failing run
            run.log.append((position, name, STOPPED, str(error).splitlines()[0] if str(error) else None))
            ended = True
        if ingest_only and name == INGEST:
            ended = True
    return run


@dataclass(frozen=True)
class TrainingSetConfig:
    catalog: Sequence[Source]
    out_path: str
    id_column: str = "example_id"
    splits: Sequence[str] = ()
    lead: str = ""
    vocab_size: int = 50_000
    max_len: int = 512
    strict: bool = True
    ingest_only: bool = False


def training_set_stages(spark: SparkSession, cfg: TrainingSetConfig) -> list:
    """Catalog -> one table -> instruction text -> token arrays -> batch plan, each a stage."""

    def ingest(values: dict[str, Any]) -> str:
        tables, report = load_with_report(spark, cfg.catalog)
        values["report"] = report
        failed = report.filter(F.col("status") != LOADED).count()
        if cfg.strict and failed:
            raise StageFailed(f"{failed} of {len(cfg.catalog)} sources could not be read")
        if not tables:
            raise StageFailed("no source could be read")
        chosen = [select_split(t, cfg.splits) for t in tables.values()]
        values["examples"], clash = concat_or_first(chosen, strict=cfg.strict)
        return clash or f"{len(tables)} sources"

    def render(values: dict[str, Any]) -> str:
        examples = non_empty(values["examples"], "catalog")
        values["text"] = require_columns(render_instruction(examples, cfg.lead), ("text", cfg.id_column))
        return f"{len(values['text'].columns)} columns"

    def arrays(values: dict[str, Any]) -> str:
        vocab = materialize(build_vocab(values["text"], cfg.vocab_size), "vocab")
        encoded = encode(values["text"], vocab, cfg.max_len, 2, keys=("source", cfg.id_column))
        save_dataset(training_arrays(encoded, cfg.max_len, 0), f"{cfg.out_path}/arrays", split="source")
        return f"length {cfg.max_len}"

    def batches(values: dict[str, Any]) -> str:
        keyed = values["text"].select(F.concat_ws("/", "source", F.col(cfg.id_column).cast("string")).alias("row_key"))
        save_dataset(batch_plan(keyed, "row_key"), f"{cfg.out_path}/batches", split="epoch")
        return "batches written"

    return [(INGEST, ingest), ("render", render), ("arrays", arrays), ("batches", batches)]
