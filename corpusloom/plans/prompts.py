"""Every prompt of every conversation as one plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from corpusloom.operators.conversations import (
    EXIT_COMMANDS,
    MAX_ROUNDS,
    RESET_COMMANDS,
    prompt_at_turn,
)
from corpusloom.plans.ordered import MAX_ROWS_PER_KEY, with_runs


def conversation_prompts(
    conv: DataFrame,
    templates: Mapping[str, str],
    max_rounds: int = MAX_ROUNDS,
    resets: Sequence[str] = RESET_COMMANDS,
    exits: Sequence[str] = EXIT_COMMANDS,
    keys: Sequence[str] = ("conv_id",),
    turn: str = "turn",
    split_above: int | None = MAX_ROWS_PER_KEY,
) -> DataFrame:
    """Exit, reset, system prompt, history window, rendering: one row per user message.

    ``split_above`` is the number of rows from which one conversation is worked on in parts; null leaves out
    the count that finds such conversations.
    """
    if split_above is not None:
        conv = with_runs(conv, keys, (turn,), split_above)
    return prompt_at_turn(conv, max_rounds, keys=keys, turn=turn, templates=templates, resets=resets, exits=exits)
