"""Conversation tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import COMMANDS_SQL, TEMPLATE_SQL, TEMPLATES, command_talk, event_chunks, query, table
from corpusloom.functions.text import detect_lang, normalize_command, strip, strip_think_text
from corpusloom.operators.conversations import (
    attach_system_prompt,
    cut_at_exit,
    first_system,
    mark_segments,
    prompt_at_turn,
    prompt_ranges,
    render_prompt,
    segment_on_reset,
    trim_history,
)
from corpusloom.operators.sessions import idle_sessions, session_spans
from corpusloom.plans.ordered import with_runs, without_runs
from corpusloom.plans.prompts import conversation_prompts

LINE_SQL = """CASE role WHEN 'system' THEN '<|system|>' WHEN 'user' THEN '<|user|>' WHEN 'assistant' THEN '<|assistant|>' END
  || '\n' || text || '\n\n'"""


def _conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_runs(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"])


@query(
    f"""WITH {COMMANDS_SQL}, heads AS (
      SELECT conv_id, arg_min(role, turn) AS first_role, arg_min(text, turn) FILTER (role = 'user') AS first_user
      FROM talk GROUP BY conv_id)
    SELECT conv_id, turn, role, text FROM talk
    UNION ALL SELECT conv_id, -1, 'system', {TEMPLATE_SQL} FROM heads
    WHERE first_role <> 'system' AND first_user IS NOT NULL"""
)
def d1_attach_system_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_system_prompt(command_talk(spark, sf_dir), TEMPLATES)


@query(
    f"""SELECT conv_id, string_agg({LINE_SQL}, '' ORDER BY turn) || '<|assistant|>' AS prompt
        FROM conversations GROUP BY conv_id"""
)
def e4_render_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_prompt(table(spark, sf_dir, "conversations"))


@query(
    """SELECT conv_id, arg_min(text, turn) AS system_text FROM conversations WHERE role = 'system' GROUP BY conv_id"""
)
def e6_first_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_system(table(spark, sf_dir, "conversations"))


def _trim_sql(rounds: int) -> str:
    return f"""
    SELECT conv_id, turn, role, text FROM (
      SELECT *, max(CASE WHEN role = 'assistant' THEN pos END) OVER (PARTITION BY conv_id) AS a,
             min(CASE WHEN role = 'system' THEN turn END) OVER (PARTITION BY conv_id) AS s
      FROM (SELECT *, sum(CASE WHEN role <> 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS pos
            FROM conversations))
    WHERE CASE WHEN role = 'system' THEN turn = s ELSE pos > coalesce(a, 0) - {2 * rounds} END"""


@query(_trim_sql(1))
def f1_trim_history_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_runs(trim_history(_conv(spark, sf_dir), 1))


@query(_trim_sql(2))
def f1_trim_history_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_runs(trim_history(_conv(spark, sf_dir), 2))


# a third of all rows and more in one conversation
HOT_TALK_SQL = """hot_talk AS (
  SELECT CASE WHEN conv_id % 3 = 0 THEN -1 ELSE conv_id END AS conv_id, conv_id * 100 + turn AS turn, role, text FROM conversations)"""


def hot_talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    hot = F.when(F.col("conv_id") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("conv_id"))
    talk = conv.select(hot.alias("conv_id"), (F.col("conv_id") * 100 + F.col("turn")).alias("turn"), "role", "text")
    return with_runs(talk, ["conv_id"], ["turn"], 16)


@query(f"WITH {HOT_TALK_SQL} {_trim_sql(2).replace('FROM conversations', 'FROM hot_talk')}")
def f1_trim_history_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_runs(trim_history(hot_talk(spark, sf_dir), 2))


def _prompts_sql(source: str, rounds: int, segment: str = "0") -> str:
    return f"""
    numbered AS (
      SELECT *, count(*) OVER (PARTITION BY conv_id, segment ORDER BY turn) AS pos
      FROM (SELECT *, {segment} AS segment FROM {source}) WHERE role <> 'system'),
    answered AS (
      SELECT *, coalesce(max(CASE WHEN role = 'assistant' THEN pos END)
        OVER (PARTITION BY conv_id, segment ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
      FROM numbered),
    prompts AS (
      SELECT u.conv_id, u.segment, u.turn, string_agg({LINE_SQL.replace('role', 'm.role', 1).replace('text', 'm.text')}, '' ORDER BY m.turn) AS body
      FROM answered u JOIN numbered m ON m.conv_id = u.conv_id AND m.segment = u.segment
        AND m.pos BETWEEN u.a - {2 * rounds} + 1 AND u.pos
      WHERE u.role = 'user' GROUP BY ALL),
    leads AS (SELECT conv_id, min(turn) AS s_turn, arg_min({LINE_SQL}, turn) AS lead FROM {source} WHERE role = 'system' GROUP BY conv_id)
    """


@query(
    f"""WITH {_prompts_sql('conversations', 1)}
    SELECT conv_id, turn, coalesce(lead, '') || body || '<|assistant|>' AS prompt
    FROM prompts LEFT JOIN leads USING (conv_id)"""
)
def f2_prompt_at_turn_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_at_turn(_conv(spark, sf_dir), 1)


@query(
    f"""WITH {_prompts_sql('conversations', 10)}
    SELECT conv_id, turn, coalesce(lead, '') || body || '<|assistant|>' AS prompt
    FROM prompts LEFT JOIN leads USING (conv_id)"""
)
def f2_prompt_at_turn_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_at_turn(_conv(spark, sf_dir))


@query(
    f"""WITH {_prompts_sql('conversations', 10)}
    SELECT conv_id, turn, greatest(a - 19, 1) AS lo, pos AS hi FROM answered WHERE role = 'user'"""
)
def f2_prompt_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_ranges(_conv(spark, sf_dir))


@query(
    f"""WITH {HOT_TALK_SQL}, {_prompts_sql('hot_talk', 2)}
    SELECT conv_id, turn, greatest(a - 3, 1) AS lo, pos AS hi FROM answered WHERE role = 'user'"""
)
def f2_prompt_ranges_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_ranges(hot_talk(spark, sf_dir), 2)


@query(
    f"""WITH {HOT_TALK_SQL}, {_prompts_sql('hot_talk', 2)}
    SELECT conv_id, turn, CASE WHEN s_turn < turn THEN lead ELSE '' END || body || '<|assistant|>' AS prompt
    FROM (SELECT conv_id, turn, body, coalesce(s_turn, turn) AS s_turn, coalesce(lead, '') AS lead FROM prompts LEFT JOIN leads USING (conv_id))"""
)
def f2_prompt_at_turn_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompt_at_turn(hot_talk(spark, sf_dir), 2)


IS_RESET = "(role = 'user' AND trim(lower(text), ' \t\n') IN ('clear', 'reset', '清除', '重置'))"
IS_EXIT = "(role = 'user' AND trim(lower(text), ' \t\n') IN ('exit', 'quit'))"
SEGMENTS_SQL = f"""segmented AS (
  SELECT * FROM (SELECT *, CAST(sum(CASE WHEN {IS_RESET} THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS segment
                 FROM {{source}}) WHERE NOT {IS_RESET})"""


@query(
    f"""WITH {COMMANDS_SQL}, {SEGMENTS_SQL.format(source='talk')}
    SELECT conv_id, turn, role, text, segment FROM segmented WHERE role <> 'system'
    UNION ALL
    SELECT conv_id, turn, role, text, unnest(range(segment, last_segment + 1)) AS segment
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r,
          max(last_of) OVER (PARTITION BY conv_id) AS last_segment
          FROM (SELECT s.*, (SELECT max(segment) FROM segmented t WHERE t.conv_id = s.conv_id) AS last_of
                FROM segmented s WHERE role = 'system')) WHERE r = 1"""
)
def f3_segment_on_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = with_runs(command_talk(spark, sf_dir), ["conv_id"], ["turn"])
    return without_runs(segment_on_reset(talk))


@query(
    """SELECT user_id, event_id, segment FROM (
      SELECT user_id, event_id, event_type,
             CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS segment
      FROM events) WHERE event_type <> 'signup'"""
)
def f3_mark_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_runs(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])
    marked = mark_segments(events, ("signup",), ["user_id"], ["ts", "event_id"], role=None, text="event_type")
    return marked.select("user_id", "event_id", "segment")


@query(
    """SELECT user_id, event_id FROM (
      SELECT user_id, event_id, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gone
      FROM events) WHERE gone = 0"""
)
def f4_cut_at_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = with_runs(table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])
    return cut_at_exit(events, ("error",), ["user_id"], ["ts", "event_id"], role=None, text="event_type").select("user_id", "event_id")


# exit -> reset -> system prompt -> history -> rendering
PROMPTS_CHAIN_SQL = f"""WITH {COMMANDS_SQL},
  live AS (SELECT * FROM (SELECT *, max(CASE WHEN {IS_EXIT} THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS gone FROM talk) WHERE gone = 0),
  {SEGMENTS_SQL.format(source='live')},
  heads AS (SELECT conv_id, arg_min(role, turn) AS first_role, arg_min(text, turn) FILTER (role = 'user') AS first_user FROM segmented GROUP BY conv_id),
  led AS (SELECT conv_id, turn, role, text, segment AS seg FROM segmented
          UNION ALL SELECT conv_id, -1, 'system', {TEMPLATE_SQL}, 0 FROM heads WHERE first_role <> 'system' AND first_user IS NOT NULL),
  {_prompts_sql('led', 1, 'seg')}
  SELECT conv_id, segment, turn, coalesce(lead, '') || body || '<|assistant|>' AS prompt FROM prompts LEFT JOIN leads USING (conv_id)"""


@query(PROMPTS_CHAIN_SQL)
def conversation_prompts_all_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_prompts(command_talk(spark, sf_dir), TEMPLATES, max_rounds=1)


def _sessions_sql(seconds: int) -> str:
    return f"""sessions AS (
      SELECT user_id, ts, event_id, CAST(sum(CASE WHEN ts - last > INTERVAL {seconds} SECOND THEN 1 ELSE 0 END)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS last FROM events))"""


HOT_EVENTS_SQL = _sessions_sql(600).replace("FROM events)", "FROM (SELECT CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS user_id, ts, event_id FROM events))")


@query(f"WITH {HOT_EVENTS_SQL} SELECT user_id, event_id, session FROM sessions")
def f9_idle_sessions_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    hot = F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    runs = with_runs(events.select(hot.alias("user_id"), "ts", "event_id"), ["user_id"], ["ts", "event_id"], 200)
    return idle_sessions(runs, 600).select("user_id", "event_id", "session")


def _sessions(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    events = with_runs(table(spark, sf_dir, "events").select("user_id", "ts", "event_id"), ["user_id"], ["ts", "event_id"])
    return idle_sessions(events, seconds)


@query(f"WITH {_sessions_sql(600)} SELECT user_id, event_id, session FROM sessions")
def f9_idle_sessions_600s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir, 600).select("user_id", "event_id", "session")


@query(
    f"""WITH {_sessions_sql(21600)} SELECT user_id, session, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n
        FROM sessions GROUP BY user_id, session"""
)
def f9_idle_sessions_6h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_spans(_sessions(spark, sf_dir, 21600))


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(text, '[\\x{4E00}-\\x{9FFF}]') THEN 'zh' ELSE 'en' END AS detected
       FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '你好。' || text ELSE text END AS text FROM documents)"""
)
def h3_detect_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("你好。"), "text")).otherwise(F.col("text"))
    return docs.select("doc_id", detect_lang(text).alias("detected"))


@query(
    """SELECT event_id, trim(lower(event_type)) AS command, trim(props, ' \t\n') AS stripped FROM events"""
)
def h7_normalize_command(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    padded = F.concat(F.lit("\t "), F.upper("event_type"), F.lit(" \n"))
    wrapped = F.concat(F.lit("　\t"), "props", F.lit("\r\n"))
    return events.select("event_id", normalize_command(padded).alias("command"), strip(wrapped).alias("stripped"))


@query(
    """SELECT doc_id, regexp_replace(regexp_replace(text, '(?s)<think>.*?</think>', '\n', 'g'), '(?s)<think>.*', '') AS shown
       FROM (SELECT doc_id, left(text, 100) || '<think>' || substring(text, 101, 100)
             || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '</think>' END || substring(text, 201) AS text FROM documents)"""
)
def h10_strip_think_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    close = F.when(F.col("doc_id") % 3 == 0, "").otherwise("</think>")
    text = F.concat(
        F.substring("text", 1, 100), F.lit("<think>"), F.substring("text", 101, 100), close, F.expr("substring(text, 201)")
    )
    return docs.select("doc_id", strip_think_text(text).alias("shown"))
