"""Ordered chunk tables and long texts."""

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import (
    CHUNKS_SQL,
    EVENT_CHUNKS_SQL,
    MARKED_SQL,
    documents,
    event_chunks,
    message_chunks,
    query,
    table,
    with_markers,
)
from corpusloom.functions.text import TOKEN_PATTERN
from corpusloom.operators.chunkers import chunk_with
from corpusloom.operators.chunks import (
    assemble_text,
    budget_guard,
    budget_stops,
    chunk_text,
    rechunk,
    repetition_guard,
    reply_metrics,
    suppress_think,
    take_until_sentinel,
)
from corpusloom.operators.segments import segment_ids, segments, sentences
from corpusloom.plans.ordered import with_runs, without_runs
from corpusloom.plans.replies import filter_replies
from corpusloom.plans.spread import dealt

EVENT_ORDER = ("ts", "event_id")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_runs(event_chunks(spark, sf_dir), ["stream_id"], EVENT_ORDER)


@query(f"WITH {CHUNKS_SQL} SELECT stream_id, chunk_idx, content FROM chunks")
def u4_chunk_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_chunks(spark, sf_dir)


def doubling(text: str) -> Iterator[str]:
    """Pieces of 1, 2, 4, … characters, as for an output that starts at once and then comes in larger and larger parts."""
    at, size = 0, 1
    while at < len(text):
        yield text[at : at + size]
        at, size = at + size, 2 * size


@query(
    """SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, substring(text, 1::BIGINT << i, 1::BIGINT << i) AS content
       FROM (SELECT doc_id, text, unnest(range(length(bin(length(text))))) AS i FROM documents WHERE text <> '')"""
)
def u4_own_chunker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_with(documents(spark, sf_dir), doubling)


STRIP_SQL = "trim({}, ' \t\n\r')"


@query("SELECT conv_id || ':' || turn AS stream_id, " + STRIP_SQL.format("text") + " AS text FROM conversations")
def e2_assemble_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_text(message_chunks(spark, sf_dir))


@query("SELECT doc_id, " + STRIP_SQL.format("text") + " AS text FROM documents")
def e2_assemble_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt out as texts, so that the chunks of a document are made and joined in one task
    docs = dealt(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", F.octet_length("text"))
    return assemble_text(chunk_text(docs), keys=["doc_id"])


@query(
    f"""SELECT user_id AS stream_id, round(epoch(max(ts)) - epoch(min(ts)), 3) AS elapsed, count(*) AS n_chunks,
        CAST(len(regexp_extract_all(string_agg(event_type || ' ', '' ORDER BY event_id).trim(), '{TOKEN_PATTERN}')) AS INTEGER) AS n_tokens
        FROM events GROUP BY user_id"""
)
def e3_reply_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = event_chunks(spark, sf_dir).withColumn("content", F.concat("content", F.lit(" ")))
    metrics = reply_metrics(chunks, index="event_id")
    return metrics.withColumn("elapsed", F.round("elapsed", 3))


def _repeat_sql(window: int, source: str, key: str, order: str, tested: str = "true") -> str:
    half = window // 2
    return f"""
    looked AS (SELECT *, list(content) OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW) AS seen FROM {source}),
    hits AS (SELECT *, CASE WHEN {tested} AND len(seen) = {window} AND array_to_string(seen[{half + 1}:{window}], '') <> ''
               AND array_to_string(seen[1:{half}], '') = array_to_string(seen[{half + 1}:{window}], '') THEN 1 ELSE 0 END AS hit FROM looked),
    fresh AS (SELECT * FROM (SELECT *, max(hit) OVER (PARTITION BY {key} ORDER BY {order}) AS stopped FROM hits) WHERE stopped = 0)"""


LINES_SQL = """lines AS (
  SELECT doc_id, CAST(i AS INTEGER) AS line_no, ls[i + 1] AS content
  FROM (SELECT doc_id, ls, unnest(range(len(ls))) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS ls FROM documents)))"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return chunk_text(docs, pattern="[^\n]*\n|[^\n]+", index="line_no")


def _guarded_lines(spark: SparkSession, sf_dir: str, window: int) -> DataFrame:
    lines = with_runs(_lines(spark, sf_dir), ["doc_id"], ["line_no"])
    return without_runs(repetition_guard(lines, window, ["doc_id"], ["line_no"]))


@query(f"WITH {LINES_SQL}, {_repeat_sql(4, 'lines', 'doc_id', 'line_no')} SELECT doc_id, line_no, content FROM fresh")
def f5_repetition_guard_4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guarded_lines(spark, sf_dir, 4)


@query(f"WITH {LINES_SQL}, {_repeat_sql(2, 'lines', 'doc_id', 'line_no')} SELECT doc_id, line_no, content FROM fresh")
def f5_repetition_guard_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guarded_lines(spark, sf_dir, 2)


# a third of all events in one stream
HOT_EVENTS_SQL = EVENT_CHUNKS_SQL.replace("SELECT user_id AS", "SELECT CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS")


@query(f"WITH {HOT_EVENTS_SQL}, {_repeat_sql(8, 'event_chunks', 'stream_id', 'ts, event_id')} SELECT stream_id, event_id, content FROM fresh")
def f5_repetition_guard_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = F.when(F.col("stream_id") % 3 == 0, F.lit(-1)).otherwise(F.col("stream_id"))
    order = ["ts", "event_id"]
    events = with_runs(event_chunks(spark, sf_dir).withColumn("stream_id", hot), ["stream_id"], order, 200)
    fresh = repetition_guard(events, 8, ["stream_id"], order, block_rows=256)
    return without_runs(fresh).select("stream_id", "event_id", "content")


_BUDGET_SQL = f"""WITH {EVENT_CHUNKS_SQL}, timed AS (
  SELECT *, row_number() OVER w AS n, epoch(ts) - epoch(first(ts) OVER w) AS elapsed
  FROM event_chunks WINDOW w AS (PARTITION BY stream_id ORDER BY ts, event_id)),
  marked AS (SELECT *, CASE WHEN elapsed > 1000000 THEN 'max_seconds' WHEN n > 40 THEN 'max_tokens' END AS stop_reason FROM timed)"""


@query(f"{_BUDGET_SQL} SELECT stream_id, event_id, content FROM marked WHERE stop_reason IS NULL")
def f6_budget_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = budget_guard(_events(spark, sf_dir), 40, 1_000_000, order=EVENT_ORDER)
    return kept.select("stream_id", "event_id", "content")


@query(
    f"""{_BUDGET_SQL} SELECT stream_id, count(*) FILTER (stop_reason IS NULL) AS kept,
        arg_min(stop_reason, n) FILTER (stop_reason IS NOT NULL) AS stop_reason FROM marked GROUP BY stream_id"""
)
def f6_budget_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget_stops(_events(spark, sf_dir), 40, 1_000_000, order=EVENT_ORDER)


@query(
    f"""WITH {EVENT_CHUNKS_SQL} SELECT stream_id, event_id, content FROM (
      SELECT *, max(CASE WHEN content = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY stream_id ORDER BY ts, event_id) AS ended
      FROM event_chunks) WHERE ended = 0 AND content <> ''"""
)
def f7_take_until_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = take_until_sentinel(_events(spark, sf_dir), "purchase", order=EVENT_ORDER)
    return kept.select("stream_id", "event_id", "content")


def _think_sql(source: str, key: str, order: str, opener: str, closer: str) -> str:
    opens, closes = f"contains(content, '{opener}')", f"contains(content, '{closer}')"
    return f"""
    states AS (SELECT *, {opens} AS is_open, {closes} AND NOT {opens} AS is_close FROM {source}),
    flagged AS (SELECT *, last_value(CASE WHEN is_open THEN 1 WHEN is_close THEN 0 END IGNORE NULLS)
        OVER (PARTITION BY {key} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS hide FROM states),
    shown AS (SELECT * EXCLUDE (content), CASE WHEN is_close THEN '\n' ELSE content END AS content FROM flagged
        WHERE is_close OR coalesce(hide, 0) = 0)"""


@query(
    f"""WITH {EVENT_CHUNKS_SQL}, {_think_sql('event_chunks', 'stream_id', 'ts, event_id', 'signup', 'error')}
    SELECT stream_id, event_id, content FROM shown"""
)
def f8_suppress_think(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = suppress_think(_events(spark, sf_dir), "signup", "error", order=EVENT_ORDER)
    return shown.select("stream_id", "event_id", "content")


def _rechunk_sql(source: str, min_len: int = 5) -> str:
    """The fold over one list per stream, with the pieces so far in the accumulator."""
    blank = "out: CAST([] AS STRUCT(s BIGINT, t VARCHAR)[])"
    return f"""
    listed AS (
      SELECT stream_id, list({{s: CAST(chunk_idx AS BIGINT), t: content, {blank}}} ORDER BY chunk_idx) AS items
      FROM {source} WHERE content <> '' GROUP BY stream_id),
    folded AS (
      SELECT stream_id, list_reduce(list_concat([{{s: CAST(-1 AS BIGINT), t: '', {blank}}}], items), lambda a, x:
        CASE WHEN length(a.t) + length(x.t) >= {min_len}
          THEN {{s: CAST(-1 AS BIGINT), t: '', out: list_append(a.out, {{s: CASE WHEN a.t = '' THEN x.s ELSE a.s END, t: a.t || x.t}})}}
          ELSE {{s: CASE WHEN a.t = '' THEN x.s ELSE a.s END, t: a.t || x.t, out: a.out}} END) AS f
      FROM listed),
    pieces AS (
      SELECT stream_id, CAST(p.s AS INTEGER) AS chunk_idx, p.t AS content
      FROM (SELECT stream_id, unnest(CASE WHEN f.t <> '' THEN list_append(f.out, {{s: f.s, t: f.t}}) ELSE f.out END) AS p FROM folded))"""


@query(f"WITH {CHUNKS_SQL}, {_rechunk_sql('chunks')} SELECT stream_id, chunk_idx, content FROM pieces")
def h9_rechunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rechunk(message_chunks(spark, sf_dir))


def _filter_sql(max_tokens: int, window: int) -> str:
    return f"""WITH {MARKED_SQL},
  within AS (SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY stream_id ORDER BY chunk_idx) AS n FROM marked) WHERE n <= {max_tokens}),
  {_think_sql('within', 'stream_id', 'chunk_idx', '<think>', '</think>')},
  {_rechunk_sql('shown')},
  whole AS (SELECT * FROM pieces WHERE length(content) >= 5 OR stream_id NOT IN (
    SELECT stream_id FROM marked GROUP BY stream_id HAVING count(*) > {max_tokens})),
  {_repeat_sql(window, 'whole', 'stream_id', 'chunk_idx', 'length(content) >= 5')}
  SELECT stream_id, chunk_idx, content FROM fresh"""


FILTER_REPLIES_SQL = _filter_sql(200, 4)


@query(FILTER_REPLIES_SQL)
def filter_replies_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_replies(with_markers(message_chunks(spark, sf_dir)), max_tokens=200, window=4)


@query(_filter_sql(20480, 32))
def filter_replies_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_replies(with_markers(message_chunks(spark, sf_dir)))


MARKS = "。！？!?;；"
# the test texts end their sentences with a full stop, which is not a mark
_MARKED_DOCS = "(SELECT doc_id, replace(text, '.', '!') AS text FROM documents)"
SENTENCES_SQL = f"""list_filter(regexp_extract_all(text, '[^{MARKS}]*[{MARKS}]|[^{MARKS}]+'), lambda p: trim(p, ' \t\n\r') <> '')"""


def _marked_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).withColumn("text", F.replace("text", F.lit("."), F.lit("!")))


@query(
    f"""SELECT doc_id, CAST(i AS INTEGER) AS piece_no, ps[i + 1] AS piece FROM (
      SELECT doc_id, ps, unnest(range(len(ps))) AS i FROM (SELECT doc_id, {SENTENCES_SQL} AS ps FROM {_MARKED_DOCS}))"""
)
def h4_split_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(_marked_docs(spark, sf_dir))


def _pack_sql(limit: int) -> str:
    return f"""
    packed AS (
      SELECT doc_id, list_reduce(list_concat([{{tmp: '', out: CAST([] AS VARCHAR[])}}],
          list_transform({SENTENCES_SQL}, lambda p: {{tmp: p, out: CAST([] AS VARCHAR[])}})), lambda a, x:
        CASE WHEN length(a.tmp) + length(x.tmp) < {limit} THEN {{tmp: a.tmp || x.tmp, out: a.out}}
             WHEN a.tmp <> '' THEN {{tmp: x.tmp, out: list_append(a.out, a.tmp)}}
             ELSE {{tmp: x.tmp, out: a.out}} END) AS f
      FROM {_MARKED_DOCS}),
    segs AS (
      SELECT doc_id, CAST(i AS INTEGER) AS seg_no, s[i + 1] AS text
      FROM (SELECT doc_id, s, unnest(range(len(s))) AS i
            FROM (SELECT doc_id, CASE WHEN f.tmp <> '' THEN list_append(f.out, f.tmp) ELSE f.out END AS s FROM packed)))"""


@query(f"WITH {_pack_sql(100)} SELECT doc_id, seg_no, text FROM segs")
def h5_pack_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(_marked_docs(spark, sf_dir))


@query(
    f"""WITH {_pack_sql(100)} SELECT doc_id, seg_no, left(md5(CAST(doc_id AS VARCHAR)), 8) AS session,
        left(md5(CAST(doc_id AS VARCHAR)), 8) || '_seg' || lpad(CAST(seg_no AS VARCHAR), CAST(greatest(3, length(CAST(seg_no AS VARCHAR))) AS INTEGER), '0') AS name,
        strftime(TIMESTAMP '2024-03-01 00:00:00' + doc_id * INTERVAL 1 SECOND, '%Y%m%d_%H%M%S') AS stamp,
        trim(text, ' \t\n\r') AS text FROM segs"""
)
def h6_segment_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _marked_docs(spark, sf_dir)
    start = F.unix_timestamp(F.lit("2024-03-01 00:00:00"))
    return segment_ids(docs, "doc_id", F.timestamp_seconds(start + F.col("doc_id")))
