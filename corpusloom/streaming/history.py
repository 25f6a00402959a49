"""Conversation histories kept as state, one prompt per user message."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import CJK_FIRST, CJK_LAST
from corpusloom.operators.conversations import EXIT_COMMANDS, MAX_ROUNDS, PROMPT_SUFFIX, RESET_COMMANDS
from corpusloom.operators.instruct import ROLE_TAGS
from corpusloom.streaming.buckets import BUCKETS, apply_in_buckets
from corpusloom.streaming.timeouts import DELAY

STATE = (
    "next_turn: bigint, begun: string, lead: string, segment: bigint, ended: boolean, messages: array<struct<role: string, text: string>>,"
    " waiting: array<struct<turn: bigint, role: string, text: string>>"
)
FRESH = (0, None, None, 0, False, [], [])
# Role of the row that ends a conversation; it has no turn.
CLOSING_ROLE = "||CLOSE||"
CJK = re.compile(f"[{chr(CJK_FIRST)}-{chr(CJK_LAST)}]")


def stream_history(
    conv: DataFrame,
    templates: Mapping[str, str],
    max_rounds: int = MAX_ROUNDS,
    resets: Sequence[str] = RESET_COMMANDS,
    exits: Sequence[str] = EXIT_COMMANDS,
    tags: Mapping[str, str] = ROLE_TAGS,
    suffix: str = PROMPT_SUFFIX,
    default_lang: str = "en",
    idle_ms: int | None = None,
    ts: str | None = None,
    delay: str = DELAY,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Streaming form of the batch prompts: ``(conv_id, segment, turn, prompt)`` per user message.

    Turns count from 0; rows that arrive ahead of a missing one wait for it, and a row without a turn is none. The
    state is the system message and the live history, which a reply trims to ``2 * max_rounds`` messages, besides
    the waiting rows.

    With ``ts``, the column of event times, a conversation ends when the watermark (the latest time seen less ``delay``)
    passes its latest row by ``idle_ms``: what waits behind a gap then comes out in turn order and the state is
    dropped. No clock is involved; ``drain`` with an ``end_of_input`` ends all conversations. Rows older than the watermark are
    late and left out.

    A conversation also ends with its row of ``closing_turns``. Append those rows to a stored backlog behind all others,
    or rows behind a gap stay in the state. Without ``ts``, ``idle_ms`` is time on the clock without input. Set it for a
    query that runs all the time; a run over what is there now would wait for such timeouts without end.

    The conversations share ``buckets`` states (see ``apply_in_buckets``).
    """
    out_schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("turn", T.LongType()),
            T.StructField("prompt", T.StringType()),
        ]
    )

    def line(role: str, text: str) -> str:
        return f"{tags[role]}\n{text}\n\n" if role in tags else ""

    def step(key: str | None, values: tuple | None, rows: list[tuple], closed: bool) -> tuple[list[tuple], tuple | None]:
        next_turn, begun, lead, segment, ended, live, ahead = values or FRESH
        messages = [tuple(message) for message in live]
        waiting = {row[0]: tuple(row) for row in ahead}
        out: list[tuple[int, int, str]] = []

        def advance() -> None:
            """Take the waiting row that is next."""
            nonlocal next_turn, begun, lead, segment, ended, messages
            turn, role, text = waiting.pop(next_turn)
            next_turn += 1
            command = text.strip().lower() if role == "user" else None
            if command in exits:
                ended = True
                return
            if command in resets:
                segment, messages = segment + 1, []
                return
            begun = begun or role
            if role == "system":
                if begun == "system" and lead is None:
                    lead = text
                return
            if role == "user" and lead is None:
                lead = templates["zh"] if CJK.search(text) and "zh" in templates else templates[default_lang]
            messages.append((role, text))
            if role == "assistant":
                messages = messages[-2 * max_rounds :]
            elif role == "user":
                body = "".join(line(r, t) for r, t in [("system", lead), *messages])
                out.append((segment, turn, body + suffix))

        for turn, role, text in rows:
            if pd.isna(turn):
                closed = closed or role == CLOSING_ROLE
            elif turn >= next_turn and not ended:
                waiting[int(turn)] = (int(turn), role, text or "")
        while not ended and next_turn in waiting:
            advance()
        if closed:
            # no more input: what waits behind a gap comes out in order
            for turn in sorted(waiting):
                if not ended:
                    next_turn = turn
                    advance()
            return out, None
        if key is None and not waiting and not next_turn:
            return out, None  # the end of the input, which is no conversation
        if ended:
            messages, waiting = [], {}
        rest = [waiting[turn] for turn in sorted(waiting)]
        return out, (next_turn, begun, lead, segment, ended, messages, rest)

    return apply_in_buckets(conv, "conv_id", ["turn", "role", "text"], step, out_schema, STATE, idle_ms, ts, delay, buckets)


def closing_turns(conv: DataFrame) -> DataFrame:
    """The end of every conversation of a stored table: a row each without a turn, in the columns of ``conv``."""
    ids = conv.select("conv_id").distinct()
    cols = [F.col(f.name) if f.name == "conv_id" else F.lit(CLOSING_ROLE if f.name == "role" else None) for f in conv.schema.fields]
    return ids.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(cols, conv.schema.fields)])
