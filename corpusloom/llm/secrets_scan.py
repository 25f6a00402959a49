"""Secret scans: fixed patterns per text, and candidates judged by who owns them across the corpus.

Base kinds, leftmost and non-overlapping each: ``assign`` (a name such as password or api_key, ``:`` or ``=``, a
value of 12 characters or more), ``access`` (``AKIA…`` of 18 or more), ``hex`` (16 or more of ``[0-9a-f]``).

Further candidates are long tokens of mixed characters and values after other credential names. Each value is
hashed with a key; hashes are counted by distinct repositories, owners and texts over the whole corpus. A value that few
of each hold and that looks alive (varied, of several character classes) becomes a span of kind ``owned``; one that many
repositories have, or many different texts of one repository, is a widely copied example and stays text. Copies of one
text within a repository count once. Base spans stay whatever their count is; their counts tell which of them are copied.

Null texts count as empty. Null repositories or owners count as one unnamed repository or owner; without a column
``lang`` the owner is the repository. Repeated rows give repeated rows and count once. A text of any length is scanned
whole, in time linear in its length and spans. An empty table gives no rows. Other columns may have any names. Offsets
are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from corpusloom.llm.common import materialize

# The patterns of the base kinds and of further candidates.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
NAMED = re.compile(r"""(?:credential|auth|bearer|private_?key|access_?key|pwd)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{12,})""", re.IGNORECASE | re.ASCII)
KINDS = ("assign", "access", "hex", "owned")
OWNED = KINDS.index("owned")
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
_NAMED_WORDS = ("credential", "auth", "bearer", "private", "access", "pwd")

# A value is owner-specific if at most so many repositories, owners and different texts hold it.
MAX_REPOSITORIES = 2
MAX_OWNERS = 2
MAX_TEXTS = 16
MIN_ENTROPY = 3.5

_SPAN = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.binary())])
_SPANS = "array<struct<kind:int,start:int,end:int,value:binary>>"


def looks_alive(value: str) -> bool:
    """Varied enough, and digits among letters, to be a generated credential."""
    if not any(c.isdigit() for c in value) or not any(c.isalpha() for c in value):
        return False
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values()) >= MIN_ENTROPY


def scan(text: str) -> tuple[list[tuple[int, int, int, str]], list[tuple[int, int, int, str]]]:
    """Base spans and further candidates of a text: ``(kind, start, end, value)``."""
    base, more = [], []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        base += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        base += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    base += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    found = [(m.start(), m.end()) for m in TOKEN.finditer(text)]
    if any(w in low for w in _NAMED_WORDS):
        found += [m.span(1) for m in NAMED.finditer(text)]
    base.sort(key=lambda s: (s[1], s[0]))
    covered = _runs([(x, y) for _, x, y, _ in base])
    end, at = -1, 0
    for a, b in sorted(found):
        while at < len(covered) and covered[at][1] <= a:
            at += 1
        inside = at < len(covered) and covered[at][0] < b
        if a >= end and not inside and looks_alive(text[a:b]):
            more.append((OWNED, a, b, text[a:b]))
            end = b
    return base, more


def _runs(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans sorted by start, as spans that do not overlap."""
    runs: list[tuple[int, int]] = []
    for a, b in spans:
        if runs and a < runs[-1][1]:
            runs[-1] = (runs[-1][0], max(runs[-1][1], b))
        else:
            runs.append((a, b))
    return runs


def _scan(key: bytes):
    def hashed(spans):
        return [{"kind": k, "start": a, "end": b, "value": hashlib.blake2b(v.encode(), digest_size=16, key=key).digest()} for k, a, b, v in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t or "") for t in batch.column("text").to_pylist()]
            columns = [pa.array([hashed(f[k]) for f in found], pa.list_(_SPAN)) for k in (0, 1)]
            keys = pa.array([hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("repository"), batch.column("owner"), keys, *columns],
                names=["doc_id", "repository", "owner", "text_key", "base", "more"],
            )

    return run


def ownership(spans: DataFrame) -> DataFrame:
    """``value, n_repositories, n_owners, n_texts``: distinct holders of every hashed value, combined before the shuffles."""
    held = spans.select("value", "repository", "owner", "text_key").distinct()
    return held.groupBy("value").agg(*[F.countDistinct(c).alias(n) for c, n in (("repository", "n_repositories"), ("owner", "n_owners"), ("text_key", "n_texts"))])


def owner_specific() -> Column:
    return (F.col("n_repositories") <= MAX_REPOSITORIES) & (F.col("n_owners") <= MAX_OWNERS) & (F.col("n_texts") <= MAX_TEXTS)


def secret_spans(docs: DataFrame, repository: str = "source", owner: Column | None = None, text_col: str = "text", key: bytes = b"") -> DataFrame:
    """``doc_id, text_key, base, owned, n_copied`` for every row.

    ``base`` and ``owned`` are arrays of spans with hashed values, never the values themselves; ``n_copied`` counts
    the base spans whose value many hold. ``owner`` is a column, by default repository and, where there is one, language.
    """
    repo = F.coalesce(docs[repository].cast("string"), F.lit(""))
    by_default = [docs[c].cast("string") for c in (repository, "lang") if c in docs.columns]
    owner = F.concat_ws(":", *by_default) if owner is None else owner
    rows = docs.select(docs["doc_id"], repo.alias("repository"), F.coalesce(owner, F.lit("")).alias("owner"), docs[text_col].alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, repository string, owner string, text_key binary, base {_SPANS}, more {_SPANS}"
    rows = rows.mapInArrow(_scan(key), schema).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "secrets-scan")
    held = rows.select("row", "text_key", "repository", "owner", F.explode(F.concat("base", "more")).alias("s")).withColumn("value", F.col("s.value"))
    judged = held.join(ownership(held), "value")
    per_row = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when((F.col("s.kind") == OWNED) & owner_specific(), F.struct("s.start", "s.end")))).alias("owned"),
        F.count_if((F.col("s.kind") != OWNED) & ~owner_specific()).alias("n_copied"),
    )
    found = rows.join(per_row, "row", "left")
    owned = F.coalesce("owned", F.expr("cast(array() AS array<struct<start:int,end:int>>)"))
    return found.select("doc_id", "text_key", "base", owned.alias("owned"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"))


def n_of(kind: str) -> Column:
    """Base spans of one kind."""
    return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def base_spelled() -> Column:
    """``kind:start:end`` of the base spans by start, then kind, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform("base", lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def all_spelled() -> Column:
    """Base and owned spans together by start, then kind, joined by commas."""
    both = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))),
        F.transform("owned", lambda s: F.struct(s["start"].alias("start"), F.lit(OWNED).alias("kind"), s["end"].alias("end"))),
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(F.array_sort(both), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(docs: DataFrame, mark: str = "<secret>", text_col: str = "text", length_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with every base and owned span replaced by ``mark``, same columns; clean rows stay as they are."""
    found = secret_spans(docs, text_col=text_col, **options)
    spans = F.concat(F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))), "owned")
    found = found.select("doc_id", "text_key", F.array_sort(spans).alias("spans")).filter(F.size("spans") > 0)
    found = found.dropDuplicates(["doc_id", "text_key"]).toDF("found_id", "found_key", "spans")
    schema = docs.schema
    # columns go by their place in between, so that no name of the table can clash
    places = {name: f"c{k}" for k, name in enumerate(schema.names)}
    placed = StructType([StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(schema.fields)])
    text_at, length_at = places[text_col], places.get(length_col)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [hashlib.blake2b((t or "").encode(), digest_size=16).digest() for t in batch.column(text_at).to_pylist()]
            yield batch.append_column("key", pa.array(keys, pa.binary()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans_of = batch.column(text_at).to_pylist(), batch.column("spans").to_pylist()
            for i, spans in enumerate(spans_of):
                if spans:
                    texts[i] = without(texts[i], [(s["start"], s["end"]) for s in spans], mark)
            columns = {name: batch.column(name) for name in placed.names}
            columns[text_at] = pa.array(texts, pa.string())
            if length_at is not None:
                changed = [len(t) if s else n for t, s, n in zip(texts, spans_of, columns[length_at].to_pylist())]
                columns[length_at] = pa.array(changed, columns[length_at].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    with_key = docs.toDF(*placed.names).mapInArrow(keyed, StructType([*placed.fields, StructField("key", BinaryType())]))
    same = F.col(places["doc_id"]).eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    cut_rows = with_key.join(found, same, "left").select(*placed.names, "spans").mapInArrow(cut, placed)
    return cut_rows.toDF(*schema.names)


def without(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with spans, overlapping or not, each run of them replaced by ``mark``."""
    out, at, end = [], 0, -1
    for a, b in sorted(spans):
        if a > end or end < 0:
            out += [text[at:a], mark]
        at = end = max(end, b)
    return "".join(out) + text[at:]
