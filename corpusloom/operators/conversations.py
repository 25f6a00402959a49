"""Conversation tables ``(conv_id, turn, role, text)``: prompts, history windows, resets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import detect_lang, is_command
from corpusloom.operators.instruct import ROLE_TAGS, known_roles
from corpusloom.plans.lookup import lookup
from corpusloom.plans.ordered import RUN, WHOLE, Mark, composed, is_split, running, smallest, total
from corpusloom.plans.text import ordered_concat
from corpusloom.session import materialize

# --- fixed values -------------------------------------------------------------------------------------
MAX_ROUNDS = 10
RESET_COMMANDS = ("clear", "reset", "清除", "重置")
EXIT_COMMANDS = ("exit", "quit")
PROMPT_SUFFIX = "<|assistant|>"
# ------------------------------------------------------------------------------------------------------
SEGMENT = "segment"
SYSTEM_TURN = -1


def _is(role: str, name: str) -> Column:
    return F.coalesce(F.col(role) == name, F.lit(False))


def _by_key(key: Column, values: Mapping[str, str], default: Column) -> Column:
    chain = None
    for name, value in values.items():
        hit = key == name
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return default if chain is None else chain.otherwise(default)


def message_line(
    role: str = "role", text: str = "text", tags: Mapping[str, str] = ROLE_TAGS
) -> Column:
    """``{tag}\\n{text}\\n\\n``; null for a role without a tag."""
    tag = _by_key(F.col(role), tags, F.lit(None).cast("string"))
    return F.concat(tag, F.lit("\n"), F.coalesce(F.col(text), F.lit("")), F.lit("\n\n"))


def _template_number(text: str, templates: Mapping[str, str], default_lang: str) -> Column:
    """Which template a text asks for, as a number: small enough for hash aggregation and windows."""
    if default_lang not in templates:
        raise ValueError(f"no template for the default language {default_lang}")
    langs = list(templates)
    lang = detect_lang(text, default_lang)
    number = F.lit(langs.index(default_lang))
    for i, name in enumerate(langs):
        number = F.when(lang == name, F.lit(i)).otherwise(number)
    return number


def _template(number: Column, templates: Mapping[str, str]) -> Column:
    return F.element_at(F.array(*[F.lit(t) for t in templates.values()]), number + 1)


def attach_system_prompt(
    conv: DataFrame,
    templates: Mapping[str, str],
    default_lang: str = "en",
    keys: Sequence[str] = ("conv_id",),
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Put a system row in front of conversations that do not begin with one.

    The template follows the language of the first user message. One aggregation finds what a conversation
    needs, so no row is joined and a long conversation is combined before the shuffle.
    """
    # Only flags and numbers are aggregated, never texts: the aggregation stays in fixed-width hash buffers.
    number = _template_number(text, templates, default_lang)
    user_turn = F.when(_is(role, "user"), F.col(turn))
    carried = [F.min(c).alias(c, metadata=conv.schema[c].metadata) for c in (SEGMENT, RUN) if c in conv.columns]
    heads = (
        conv.groupBy(*keys)
        .agg(
            F.min_by(_is(role, "system"), turn).alias("_led"),
            F.min_by(number, user_turn).alias("_lang"),
            *carried,
        )
        .filter(F.col("_lang").isNotNull() & ~F.col("_led"))
    )
    prompt = _template(F.col("_lang"), templates)
    rows = heads.select(
        *keys,
        F.lit(SYSTEM_TURN).cast(conv.schema[turn].dataType).alias(turn),
        F.lit("system").alias(role),
        prompt.alias(text),
        *[c for c in (SEGMENT, RUN) if c in conv.columns],
    )
    return conv.unionByName(rows, allowMissingColumns=True)


def first_system(
    conv: DataFrame,
    keys: Sequence[str] = ("conv_id",),
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The first system message of every conversation that has one."""
    return conv.filter(_is(role, "system")).groupBy(*keys).agg(F.min_by(text, turn).alias("system_text"))


def render_prompt(
    conv: DataFrame,
    tags: Mapping[str, str] = ROLE_TAGS,
    suffix: str = PROMPT_SUFFIX,
    keys: Sequence[str] = ("conv_id",),
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    bounded: bool = False,
) -> DataFrame:
    """One prompt per conversation: all known roles in order, then the tag the answer follows."""
    lines = known_roles(conv, tuple(tags), role).withColumn("_line", message_line(role, text, tags))
    prompts = ordered_concat(lines, keys, turn, "_line", "prompt", bounded)
    return prompts.withColumn("prompt", F.concat("prompt", F.lit(suffix)))


def cut_at_exit(
    conv: DataFrame,
    commands: Sequence[str] = EXIT_COMMANDS,
    keys: Sequence[str] = ("conv_id",),
    order: Sequence[str] = ("turn",),
    role: str | None = "role",
    text: str = "text",
) -> DataFrame:
    """Drop the exit command and everything after it. Only user rows are commands when there are roles."""
    hit = is_command(text, commands)
    if role is not None:
        hit = hit & _is(role, "user")
    marked = running(conv, keys, order, _exits=total(hit.cast("int")))
    return marked.filter(F.col("_exits") == 0).drop("_exits")


def mark_segments(
    conv: DataFrame,
    commands: Sequence[str] = RESET_COMMANDS,
    keys: Sequence[str] = ("conv_id",),
    order: Sequence[str] = ("turn",),
    role: str | None = "role",
    text: str = "text",
) -> DataFrame:
    """Number the stretches between reset commands from 0 and drop the commands themselves."""
    hit = is_command(text, commands)
    if role is not None:
        hit = hit & _is(role, "user")
    flagged = conv.withColumn("_reset", hit.cast("long"))
    marked = running(flagged, keys, order, **{SEGMENT: total(F.col("_reset"))})
    return marked.filter(F.col("_reset") == 0).drop("_reset")


def segment_on_reset(
    conv: DataFrame,
    commands: Sequence[str] = RESET_COMMANDS,
    keys: Sequence[str] = ("conv_id",),
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``mark_segments`` where every later segment also begins with the first system message.

    Later system messages are not part of a history and are left out. A reset command turns into the copy of
    the system message that begins its segment, so every row becomes at most one row.
    """
    reset = is_command(text, commands) & _is(role, "user")
    flagged = conv.withColumns({"_reset": reset.cast("long"), "_system": _is(role, "system")})
    columns = [c for c in conv.columns if c not in (turn, RUN, *keys)]
    marked = running(_with_head(flagged, keys, turn, columns), keys, (turn,), **{SEGMENT: total(F.col("_reset"))})
    begins = F.col("_reset") == 1
    kept = F.when(begins, F.col("_head").isNotNull()).otherwise(
        ~F.col("_system") | (F.col(turn) == F.col(f"_head.{turn}"))
    )
    out = [F.when(begins, F.col(f"_head.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in conv.columns]
    return marked.filter(kept).select(*out, SEGMENT)


def trim_history(
    conv: DataFrame,
    max_rounds: int = MAX_ROUNDS,
    keys: Sequence[str] = ("conv_id",),
    order: Sequence[str] = ("turn",),
    role: str = "role",
) -> DataFrame:
    """The live history at the end of every conversation.

    Trimming follows a reply: what counts are the last ``2 * max_rounds`` messages up to the last reply,
    everything after that reply, and the first system message.
    """
    system = _is(role, "system")
    counts = {"_systems": system.cast("long"), "_pos": (~system).cast("long")}
    last = {"_replied": Mark("_pos", _is(role, "assistant"), "whole")}
    counted = composed(conv, keys, order, counts, last)
    since = F.col("_pos") > F.coalesce("_replied", F.lit(0)) - 2 * max_rounds
    return counted.filter(F.when(system, F.col("_systems") == 1).otherwise(since)).select(*conv.columns)


def _numbered(rows: DataFrame, history: Sequence[str], turn: str) -> DataFrame:
    """The messages of every history numbered from 1, and the number of the last reply before each."""
    before = {"_reply_pos": Mark("_pos", F.col("_reply"), "before")}
    return composed(rows, history, (turn,), {"_pos": F.lit(1).cast("long")}, before)


def _heads(rows: DataFrame, keys: Sequence[str], turn: str, columns: Sequence[str]) -> DataFrame:
    """The first system row of every key that is split into runs: ``keys, _head``. Its texts are looked up, never carried."""
    split = rows.filter((F.col(RUN) != WHOLE) & F.col("_system"))
    return materialize(split.groupBy(*keys).agg(F.min(F.struct(turn, *columns)).alias("_head")), "first-system-rows")


def _looked_up(parts: DataFrame, heads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_head`` to rows that have a ``_first`` system turn."""
    heads = heads.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_head")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]) & F.col("_first").isNotNull()
    return lookup(parts, heads, same).select(*parts.columns, "_head")


def _with_head(rows: DataFrame, keys: Sequence[str], turn: str, columns: Sequence[str]) -> DataFrame:
    """Add ``_head``, the first system row up to each row; ``_system`` tells system rows.

    Rows of split keys carry its turn from run to run, and the row itself is looked up by key.
    """
    row = F.when(F.col("_system"), F.struct(turn, *columns))
    if not is_split(rows):
        return running(rows, keys, (turn,), _head=smallest(row))
    whole = running(rows.filter(F.col(RUN) == WHOLE).drop(RUN), keys, (turn,), _head=smallest(row))
    parts = running(rows.filter(F.col(RUN) != WHOLE), keys, (turn,), _first=smallest(F.when(F.col("_system"), F.col(turn))))
    found = _looked_up(parts, _heads(rows, keys, turn, columns), keys)
    both = whole.withColumn(RUN, F.lit(WHOLE)).unionByName(found.drop("_first"))
    return both.select(*[c for c in both.columns if c != RUN], F.col(RUN).alias(RUN, metadata=rows.schema[RUN].metadata))


def _lowest(max_rounds: int) -> Column:
    """The first message of the history that a message is answered from."""
    return F.greatest(F.coalesce("_reply_pos", F.lit(0)) - 2 * max_rounds + 1, F.lit(1))


def prompt_ranges(
    conv: DataFrame,
    max_rounds: int = MAX_ROUNDS,
    keys: Sequence[str] = ("conv_id",),
    turn: str = "turn",
    role: str = "role",
) -> DataFrame:
    """``(keys, turn, lo, hi)`` per user message: which messages of its history ``prompt_at_turn`` puts in its prompt.

    Messages other than system ones are numbered from 1 inside their history. One row a prompt whatever its length,
    so the table stays linear where the prompts themselves would grow with the square of a conversation.
    """
    history = [*keys, SEGMENT] if SEGMENT in conv.columns else list(keys)
    rows = conv.filter(~_is(role, "system")).select(
        *history,
        *[c for c in (RUN,) if c in conv.columns],
        turn,
        _is(role, "user").alias("_user"),
        _is(role, "assistant").alias("_reply"),
    )
    answered = _numbered(rows, history, turn).filter("_user")
    return answered.select(*history, turn, _lowest(max_rounds).alias("lo"), F.col("_pos").alias("hi"))


def prompt_at_turn(
    conv: DataFrame,
    max_rounds: int = MAX_ROUNDS,
    tags: Mapping[str, str] = ROLE_TAGS,
    suffix: str = PROMPT_SUFFIX,
    keys: Sequence[str] = ("conv_id",),
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    templates: Mapping[str, str] | None = None,
    default_lang: str = "en",
    resets: Sequence[str] | None = None,
    exits: Sequence[str] = (),
) -> DataFrame:
    """The rendered prompt each user message is answered from.

    With a ``segment`` column (``mark_segments``) histories start anew in every segment, only the first
    system message of the conversation stays. With ``resets`` the segments are found on the way, and what follows one
    of the ``exits`` is left out: exits, resets, system message, numbers and replies are then all told by one
    composed scan. With ``templates`` a conversation that does not begin with a
    system message is led by one, as after ``attach_system_prompt`` but without another pass over the table.

    Messages are numbered inside their history. The prompt at number ``p`` holds the messages ``lo..p``, so
    it is an interval join; both sides are cut into blocks of numbers, which makes it an equality join that
    pairs a prompt only with the blocks it touches. Where no conversation is split into runs, numbering, join
    and grouping all use the one partitioning by conversation (see ``session.SETTINGS``), so the repeated
    texts of overlapping prompts are never shuffled; with runs the blocks spread a long conversation. Keys must
    not be null.
    """
    given = SEGMENT in conv.columns and resets is None
    history = [*keys, SEGMENT] if given or resets is not None else list(keys)
    user = _is(role, "user")
    reset = user & is_command(text, resets) if resets else F.lit(False)
    leaves = user & is_command(text, exits) if exits else F.lit(False)
    rows = conv.withColumn("_line", message_line(role, text, tags)).select(
        *(history if given else keys),
        *[c for c in (RUN,) if c in conv.columns],
        turn,
        "_line",
        _is(role, "system").alias("_system"),
        (user & ~reset & ~leaves).alias("_user"),
        _is(role, "assistant").alias("_reply"),
        reset.alias("_reset"),
        leaves.alias("_exit"),
        *([] if templates is None else [_template_number(text, templates, default_lang).alias("_asked")]),
    )
    out = [*history, turn, "_line", "_user", "_lead", "_pos", "_reply_pos"]
    if not is_split(rows):
        scanned = _scanned(rows.drop(RUN), keys, history, turn, tags, templates, None).select(*out)
    else:
        # rows of small conversations in one window each; those of long ones by their runs, with texts looked up
        whole = _scanned(rows.filter(F.col(RUN) == WHOLE).drop(RUN), keys, history, turn, tags, templates, None)
        heads = _heads(rows, keys, turn, ["_line"])
        parts = _scanned(rows.filter(F.col(RUN) != WHOLE), keys, history, turn, tags, templates, heads)
        scanned = whole.select(*out).unionByName(parts.select(*out))

    width = 2 * max_rounds + 1
    prompts = (
        scanned.filter("_user")
        .select(*history, turn, "_lead", F.col("_pos").alias("_p"), _lowest(max_rounds).alias("_lo"))
        .withColumn("_block", F.explode(F.sequence(F.floor(F.col("_lo") / width), F.floor(F.col("_p") / width))))
    )
    messages = scanned.select(*history, "_pos", "_line", F.floor(F.col("_pos") / width).alias("_block"))
    pairs = prompts.join(messages, [*history, "_block"]).filter("_pos between _lo and _p")
    # the system message goes in front of the first line; a role without a tag has no line
    lead = F.when(F.col("_pos") == F.col("_lo"), F.coalesce("_lead", F.lit(""))).otherwise(F.lit(""))
    lines = pairs.withColumn("_line", F.concat(lead, F.coalesce("_line", F.lit(""))))
    # one prompt is one value, so its lines fit together; no second step over blocks is needed
    joined = ordered_concat(lines, [*history, turn], "_pos", "_line", "prompt", bounded=True)
    return joined.select(*history, turn, F.concat("prompt", F.lit(suffix)).alias("prompt"))


def _scanned(
    rows: DataFrame,
    keys: Sequence[str],
    history: Sequence[str],
    turn: str,
    tags: Mapping[str, str],
    templates: Mapping[str, str] | None,
    heads: DataFrame | None,
) -> DataFrame:
    """The messages of every history with ``_lead``, ``_pos`` and ``_reply_pos``, by one composed scan of ``rows``.

    ``heads`` tells the first system lines of split conversations; else a window carries them.
    """
    said = ~F.col("_reset") & ~F.col("_exit")
    extremes = {"_begin": smallest(F.when(said, F.col(turn)))}
    if heads is None:
        extremes["_head"] = smallest(F.when(F.col("_system"), F.struct(turn, "_line")))
    else:
        extremes["_first"] = smallest(F.when(F.col("_system"), F.col(turn)))
    if templates is not None:
        extremes["_asks"] = smallest(F.when(F.col("_user"), F.struct(turn, "_asked")))
    message = said & ~F.col("_system")
    counts = {"_exits": F.col("_exit").cast("long"), "_said": message.cast("long")}
    if SEGMENT not in rows.columns:
        counts[SEGMENT] = F.col("_reset").cast("long")
        marks = {"_from": Mark("_said", F.col("_reset")), "_replied": Mark("_said", F.col("_reply"), "before")}
        scanned = composed(rows, keys, (turn,), counts, marks, extremes)
        scanned = scanned.filter((F.col("_exits") == 0) & message)
        start = F.coalesce("_from", F.lit(0))
        replied = F.when(F.col("_replied") > start, F.col("_replied") - start)
        scanned = scanned.withColumns({"_pos": F.col("_said") - start, "_reply_pos": replied})
    else:
        scanned = _numbered(composed(rows, keys, (turn,), counts, {}, extremes).filter(message), history, turn)
    if heads is not None:
        scanned = _looked_up(scanned, heads, keys)
    own = F.col("_head._line")
    if templates is not None:
        chosen = F.concat(F.lit(f"{tags['system']}\n"), _template(F.col("_asks._asked"), templates), F.lit("\n\n"))
        own = F.when(F.col(f"_head.{turn}") == F.col("_begin"), own).otherwise(chosen)
    return scanned.withColumn("_lead", own)
