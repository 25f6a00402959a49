"""Instruction examples from loosely structured rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.functions.text import fill_template, is_blank, prefix

# --- fixed values -------------------------------------------------------------------------------------
PROMPT_COLUMNS = ("text", "prompt", "input", "content")
ANSWER_COLUMNS = ("response", "completion", "output", "target")
TRAINING_COLUMNS = ("input_ids", "attention_mask", "labels")
ROLE_TAGS = {"system": "<|system|>", "user": "<|user|>", "assistant": "<|assistant|>"}
FALLBACK_PREFIX_LENGTH = 50
# ------------------------------------------------------------------------------------------------------
# Neutral defaults; every one of them is a parameter.
DEFAULT_PROMPT = "Write a short text."
DEFAULT_USER_TAG = "User"
DEFAULT_BOT_TAG = "Assistant"
FALLBACK_TEMPLATE = "{lead}User: Write a text based on: {start}...\nAssistant: "


def require_columns(df: DataFrame, columns: Sequence[str] = ("text",)) -> DataFrame:
    """Fail while planning, before any job runs, when a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; available columns: {df.columns}")
    return df


def first_truthy(df: DataFrame, candidates: Sequence[str]) -> Column:
    """The first candidate that is neither null nor empty; columns the table lacks are skipped."""
    present = [F.when(F.col(c) != "", F.col(c)) for c in candidates if c in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def prompt_of(df: DataFrame, candidates: Sequence[str] = PROMPT_COLUMNS) -> Column:
    return first_truthy(df, candidates)


def answer_of(df: DataFrame, candidates: Sequence[str] = ANSWER_COLUMNS) -> Column:
    return first_truthy(df, candidates)


def fill_default_prompt(
    df: DataFrame, column: str, default: str = DEFAULT_PROMPT, observation: Observation | None = None
) -> DataFrame:
    """Put the default where there is no prompt; ``observation`` counts them in the same pass."""
    if observation is not None:
        df = df.observe(observation, F.count_if(F.col(column).isNull()).alias("default_prompts"))
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def render_instruction(
    df: DataFrame,
    lead: str = "",
    user_tag: str = DEFAULT_USER_TAG,
    bot_tag: str = DEFAULT_BOT_TAG,
    default: str = DEFAULT_PROMPT,
    observation: Observation | None = None,
) -> DataFrame:
    """``{lead}{user}: {prompt}\\n{bot}: {answer}`` as ``text``; all other columns stay."""
    found = df.withColumn("_prompt", prompt_of(df)).withColumn("_answer", answer_of(df))
    filled = fill_default_prompt(found, "_prompt", default, observation)
    body = fill_template(
        "{lead}{user}: {prompt}\n{bot}: {answer}",
        lead=F.lit(lead),
        user=F.lit(user_tag),
        bot=F.lit(bot_tag),
        prompt="_prompt",
        answer="_answer",
    )
    return filled.withColumn("text", body).drop("_prompt", "_answer")


def render_fallback(
    df: DataFrame,
    lead: str = "",
    template: str = FALLBACK_TEMPLATE,
    length: int = FALLBACK_PREFIX_LENGTH,
    column: str = "text",
) -> DataFrame:
    """A plain prompt from the beginning of the text; null text counts as empty."""
    source = F.col(column) if column in df.columns else F.lit("")
    start = prefix(F.coalesce(source, F.lit("")), length)
    return df.withColumn("text", fill_template(template, lead=F.lit(lead), start=start))


def keep_columns(df: DataFrame, columns: Sequence[str] = TRAINING_COLUMNS) -> DataFrame:
    return df.select(*[c for c in df.columns if c in set(columns)])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose text is not empty after stripping."""
    return df.filter(~is_blank(column))


def known_roles(df: DataFrame, roles: Sequence[str] = tuple(ROLE_TAGS), column: str = "role") -> DataFrame:
    return df.filter(F.col(column).isin(*roles))


def non_empty(df: DataFrame, what: str = "dataset") -> DataFrame:
    """Fail on an empty table; looks for one row only."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df
