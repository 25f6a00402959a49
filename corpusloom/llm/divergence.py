"""How far the sources of a language differ in the words they use.

Terms are maximal runs of characters that are ASCII letters or not ASCII; only A-Z are lower-cased. A language keeps
the V terms that stand in at least ``MIN_DF`` of its documents. In a group (a source of a language, or the language as
a whole) with ``count`` occurrences of a term and N of all kept terms,
``p = 1 + floor(10^9 (count + 1) / (N + V))``, and p differs from q by ``floor((p - q) (p - q) / q)``.

``CountVectorizer`` builds the vocabulary, with ``minDF`` and no other limit. It is fitted on ``held_lists``, in which
every term reaches ``minDF`` exactly if it does so in the documents. The texts are read once: the sparse vectors of
documents are built in Arrow batches over the terms that a task meets and summed per group there, then written and
brought to the vocabulary, equal to the sums of those of the model's ``transform`` but at a fraction of its time.
Terms carry their language before them, so that one vectorizer is one per language: a term's documents are those of its
language, and vectors of different languages share no index. Where there are more terms than the driver and a task
should hold, the terms are dealt by hash into blocks of bounded size, each with a vectorizer of its own; a
block's vectors are exact parts of the whole ones.

Pairs of groups are evaluated on these sums, block of terms by block of terms. Only terms that one of the two groups
has need a look: ``sum f = V f00 + (terms of q: f(p0, q) - f00) + (terms of p: f(p, q) - f(p0, q))``, where p0 and
q0 belong to a count of 0 and f00 = f(p0, q0). All of it is in whole numbers.

Null texts, languages and sources are empty strings. Every group that occurs has its pairs, also without terms; a language
without kept terms gives pairs of value 0. Repeated rows count as documents. An empty table gives no rows. Other
columns, whatever their names, are left out.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.errors import IllegalArgumentException
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize

MIN_DF = 3
MAX_INT = 2**31 - 1
TERM_RANKS = 200
# Terms of one vectorizer, which the driver and every executor hold, and counts of groups that are summed as one row.
BLOCK_TERMS = 500_000
BLOCK_COUNTS = 200_000
# One term in so many, by hash, tells how many blocks there are to be.
PROBED = 64
# Steps that values of terms are counted in, for each doubling.
STEPS = 16
# Bytes of text whose terms a task holds at once, and distinct terms that it holds to count their documents.
STEP_BYTES = 1_000_000
HELD_TERMS = 250_000
# Entries of document vectors, then of written rows, that a task sums up before it gives them on, and terms in a row that
# it writes.
HELD_ENTRIES = 2_000_000
SUMMED_ENTRIES = 1_000_000
ROW_TERMS = 65_536
# Such rows whose terms are looked up together.
LOOKED_UP = 16
ONE = 1_000_000_000
# Between language and term; no term has it.
MARK = "\0"

# Letters lower-cased and all that is not part of a term made a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Some rows at a time and the terms of each."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
        start = 0
        while start < len(batch):
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + STEP_BYTES, side="right")))
            part = batch.slice(start, end - start)
            yield part, [text.as_buffer().to_pybytes().translate(_TABLE).split() for text in part.column("text")]
            start = end


class Numbers(dict):
    """Numbers of terms by first occurrence: a term that is looked up the first time gets the next one."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def vectors_of(lists: list[list[bytes]], indexes: list[dict[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse vectors of some documents: document, index and count of every entry, by document and index.

    Terms that an index lacks are left out, unless it is ``Numbers``.
    """
    found = [map(index.__getitem__, words) if isinstance(index, Numbers) else map(index.get, words, repeat(-1)) for words, index in zip(lists, indexes)]
    ids = [np.fromiter(some, np.int64, len(words)) for some, words in zip(found, lists)]
    cells = np.concatenate([k << 32 | some[some >= 0] for k, some in enumerate(ids)])
    cells, counts = np.unique(cells, return_counts=True)
    return cells >> 32, cells & MAX_INT, counts


def _summed(cells: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells in order and the sum of the counts of each."""
    cell, n = np.concatenate([np.zeros(0, np.int64), *cells]), np.concatenate([np.zeros(0, np.int64), *counts])
    order = np.argsort(cell)
    cell, n = cell[order], n[order]
    new = np.ones(len(cell), bool)
    new[1:] = cell[1:] != cell[:-1]
    first = np.flatnonzero(new)
    return cell[first], np.add.reduceat(n, first) if len(first) else n


def _lists(values: pa.Array | np.ndarray, ends: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _held_batch(numbers: dict[str, Numbers], groups: dict[tuple[str, str], int], cells: list[np.ndarray], counts: list[np.ndarray], min_df: int) -> pa.RecordBatch:
    """Rows of ``_HELD`` of documents read together; cells are ``term << 32 | group``, one for every term of a document."""
    langs = {lang: k for k, lang in enumerate(numbers)}
    base = np.cumsum([0, *map(len, numbers.values())])
    lang_of = np.array([langs[lang] for lang, _ in groups], np.int64)
    # terms of all languages in one row, by language, then the most frequent first
    cells = [cell + (base[lang_of[cell & MAX_INT]] << 32) for cell in cells]
    df = np.minimum(sum((np.bincount(cell >> 32, minlength=base[-1]) for cell in cells), np.zeros(base[-1], np.int64)), min_df)
    order = np.argsort(np.repeat(np.arange(len(langs)), np.diff(base)) * (min_df + 1) + min_df - df, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    cell, n = _summed([place[cell >> 32] << 32 | cell & MAX_INT for cell in cells], counts)
    term, group = cell >> 32, cell & MAX_INT
    parts = [(lang, k) for lang, a, b in zip(numbers, base.tolist(), base[1:].tolist()) for k in range(a, b, ROW_TERMS)]
    ends = np.array([*(k for _, k in parts), base[-1]])
    cell_ends = np.searchsorted(term, ends)
    held = [(df[order[a:b]] > k).sum() for a, b in zip(ends, ends[1:]) for k in range(min_df)]
    marked = [(lang + MARK).encode() + word for lang, words in numbers.items() for word in words]
    names, sources, source_ends, source = [name for _, name in groups], [], [0], np.empty(len(group), np.int32)
    for a, b in zip(cell_ends, cell_ends[1:]):
        own, source[a:b] = np.unique(group[a:b], return_inverse=True)
        sources += [names[k] for k in own.tolist()]
        source_ends.append(len(sources))
    columns = [
        pa.array([lang for lang, _ in parts], pa.string()),
        _lists(pa.array(marked, pa.binary()).take(pa.array(order)).cast(pa.string()), ends),
        _lists(np.array(held, np.int32), np.arange(len(ends)) * min_df),
        _lists(pa.array(sources, pa.string()), np.array(source_ends)),
        _lists(source, cell_ends),
        _lists((term - np.repeat(ends[:-1], np.diff(cell_ends))).astype(np.int32), cell_ends),
        _lists(n, cell_ends),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "terms", "held", "sources", "source", "term", "n"])


class Held:
    """Documents of a language that are read together: numbers of its terms and groups, and its vectors so far."""

    def __init__(self):
        self.numbers, self.groups, self.cells, self.counts, self.size = Numbers(), {}, [], [], 0

    def add(self, lang: str, sources: list[str], lists: list[list[bytes]]) -> None:
        doc, index, n = vectors_of(lists, [self.numbers] * len(lists))
        group = np.array([self.groups.setdefault((lang, source), len(self.groups)) for source in sources], np.int64)
        self.cells.append(index << 32 | group[doc])
        self.counts.append(n.astype(np.int32))
        self.size += len(n)


_HELD = "lang string, terms array<string>, held array<int>, sources array<string>, source array<int>, term array<int>, n array<long>"


def held_terms(docs: DataFrame, min_df: int) -> DataFrame:
    """What the texts hold, read once: rows of terms of a language (``terms``, behind the language) of documents read
    together, and their vectors summed per group.

    The first ``held[k]`` of the terms stand in more than k of these documents, for k below ``min_df``. An entry is
    ``n`` occurrences of ``terms[term]`` in the group of ``sources[source]``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, Held] = defaultdict(Held)

        def given() -> Iterator[pa.RecordBatch]:
            # one language at a time, as a row is made from several times its memory
            while langs:
                lang, own = langs.popitem()
                rows = _held_batch({lang: own.numbers}, own.groups, own.cells, own.counts, min_df)
                del own
                yield from (rows.slice(k, 1) for k in range(len(rows)))

        for part, lists in _slices(batches):
            docs = defaultdict(list)
            for k, lang in enumerate(part.column("lang").to_pylist()):
                docs[lang].append(k)
            sources = part.column("source").to_pylist()
            for lang, some in docs.items():
                langs[lang].add(lang, [sources[k] for k in some], [lists[k] for k in some])
            del lists
            if sum(own.size for own in langs.values()) > HELD_ENTRIES or sum(len(own.numbers) for own in langs.values()) > HELD_TERMS:
                yield from given()
        yield from given()
        pa.default_memory_pool().release_unused()  # the worker outlives the task

    return named(docs).mapInArrow(run, _HELD)


def held_lists(held: DataFrame) -> DataFrame:
    """Fewer documents (``terms``) in which a term has the same document frequency, up to ``min_df``.

    Of documents read together, the k-th list has the terms that at least k of them hold.
    """
    return held.select(F.explode(F.transform("held", lambda n: F.slice("terms", 1, n))).alias("terms"))


def named(docs: DataFrame) -> DataFrame:
    columns = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return columns.withColumn("text", F.col("text").cast("binary"))


_PART = "lang string, part int, sources array<string>, source array<int>, index array<int>, n array<long>"
_SUMS = "lang string, v long, sources array<string>, totals array<long>, source array<int>, index array<long>, n array<long>"


def group_vectors(held: DataFrame, vocabulary: Broadcast, parts: int) -> DataFrame:
    """The vectors of ``held_terms`` over a vocabulary, summed as far as a task holds them at once, in rows of a language
    and one of ``parts`` of the indexes: an entry is ``n`` occurrences of ``index`` in the group of ``sources[source]``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary.value
        groups: dict[tuple[str, str], int] = {}
        cells, sums, size = [], [], 0

        def summed() -> pa.RecordBatch:
            cell, n = _summed(cells, sums)
            group, at, names = cell >> 32, cell & MAX_INT, list(groups)
            langs = {lang: k for k, lang in enumerate(dict.fromkeys(lang for lang, _ in names))}
            key = np.array([langs[lang] for lang, _ in names], np.int64)[group] * parts + at % parts
            order = np.argsort(key.astype(np.min_scalar_type(len(langs) * parts)), kind="stable")
            keys, first = np.unique(key[order], return_index=True)
            ends, group, source, sources, source_ends = np.append(first, len(order)), group[order], np.empty(len(order), np.int32), [], [0]
            for a, b in zip(ends, ends[1:]):
                own, source[a:b] = np.unique(group[a:b], return_inverse=True)
                sources += [names[k][1] for k in own.tolist()]
                source_ends.append(len(sources))
            lang_names = list(langs)
            columns = [
                pa.array([lang_names[k // parts] for k in keys.tolist()], pa.string()),
                pa.array((keys % parts).astype(np.int32)),
                _lists(pa.array(sources, pa.string()), np.array(source_ends)),
                _lists(source, ends),
                _lists(at[order].astype(np.int32), ends),
                _lists(n[order], ends),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "part", "sources", "source", "index", "n"])

        parts_of = (batch.slice(k, LOOKED_UP) for batch in batches for k in range(0, len(batch), LOOKED_UP))
        for batch in parts_of:
            # looked up together, as Arrow hashes the vocabulary each time
            found = pc.fill_null(pc.index_in(batch.column("terms").flatten(), words), -1).to_numpy().astype(np.int64)
            ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy())
            for end, lang, terms, sources, source, term, n in zip(ends.tolist(), *batch.columns):
                known = found[end - len(terms) : end]
                group = np.array([groups.setdefault((lang.as_py(), name), len(groups)) for name in sources.as_py()], np.int64)
                at = known[term.values.to_numpy()]
                kept = at >= 0
                cells.append((group[source.values.to_numpy()] << 32 | at)[kept])
                sums.append(n.values.to_numpy()[kept])
                size += len(sums[-1])
                if size > SUMMED_ENTRIES:
                    yield summed()
                    groups, cells, sums, size = {}, [], [], 0
        if cells:
            yield summed()
        pa.default_memory_pool().release_unused()

    rows = held.select("lang", "terms", "sources", "source", "term", "n")
    return rows.mapInArrow(run, _PART)


def _sum_part(base: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        names, cells, sums = Numbers(), [], []
        for batch in rows.select(["sources", "source", "index", "n"]).to_batches():
            for sources, source, index, n in zip(*batch.columns):
                group = np.array([names[name] for name in sources.as_py()], np.int64)
                cells.append(index.values.to_numpy().astype(np.int64) << 32 | group[source.values.to_numpy()])
                sums.append(n.values.to_numpy())
        cell, n = _summed(cells, sums)
        index, group = cell >> 32, cell & MAX_INT
        totals = np.zeros(len(names), np.int64)
        np.add.at(totals, group, n)
        columns = [[key[0].as_py()], [len(np.unique(index))], [list(names)], [totals], [group.astype(np.int32)], [index + base], [n]]
        types = [pa.string(), pa.int64(), pa.list_(pa.string()), *[pa.list_(t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "v", "sources", "totals", "source", "index", "n"])

    return run


def _block_sums(held: DataFrame, lists: DataFrame, min_df: int, block: int, parts: int) -> tuple[DataFrame, DataFrame] | None:
    """``group_sums`` of one block of terms, of which ``lists`` are the documents; None where no term is kept."""
    spark = held.sparkSession
    vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=MAX_INT)
    try:
        model = vectorizer.fit(lists)
    except IllegalArgumentException as error:
        if "vocabulary size should be > 0" not in str(error):
            raise
        return None
    base = block << 32
    words = pa.array(model.vocabulary, pa.string())  # Python's own strings are many times as large
    del model
    terms = pc.replace_substring_regex(words, r"(?s)^.*\x00", "")
    named_terms = pa.table({"index": pa.array(np.arange(base, base + len(words))), "term": terms})
    vocabulary = materialize(spark.createDataFrame(named_terms, "index long, term string"), "divergence-vocabulary")
    vectors = group_vectors(held, spark.sparkContext.broadcast(words), parts)
    sums = vectors.groupBy("lang", "part").applyInArrow(_sum_part(base), _SUMS)
    return materialize(sums, "divergence-sums"), vocabulary


def n_blocks(lists: DataFrame, min_df: int, block_terms: int) -> int:
    """How many blocks keep terms below ``block_terms`` each, by the kept terms among one in ``PROBED`` by hash."""
    probe = lists.select(F.explode(F.filter("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(PROBED)) == 0)).alias("term"))
    kept = probe.groupBy("term").count().filter(F.col("count") >= min_df).count()
    return 1 + (kept + 3 * math.isqrt(kept) + 9) * PROBED // block_terms


def group_sums(docs: DataFrame, min_df: int = MIN_DF, block_terms: int = BLOCK_TERMS, block_counts: int = BLOCK_COUNTS) -> tuple[DataFrame, DataFrame]:
    """The occurrences of kept terms per group, in rows of some ``v`` terms of a language, and ``index, term``.

    An entry is ``n > 0`` occurrences of ``index`` in the group of ``sources[source]``; all entries of an index are in
    one row, by index. ``totals`` are the sums per source. A term has an index of its own in each of its languages. A row
    is made of ``block_counts`` counts on average.
    """
    held = materialize(held_terms(docs, min_df), "divergence-held")
    lists = held_lists(held)
    blocks = n_blocks(lists, min_df, block_terms)
    entries = held.agg(F.coalesce(F.sum(F.size("source")), F.lit(0))).first()[0]
    parts = 1 + entries // (blocks * block_counts)

    def own(table: DataFrame, block: int) -> DataFrame:
        in_block = F.filter("terms", lambda t: F.pmod(F.xxhash64(t, F.lit(1)), F.lit(blocks)) == block)
        return table.withColumn("terms", in_block) if blocks > 1 else table

    spark = docs.sparkSession
    sums = spark.createDataFrame([], _SUMS)
    vocabulary = spark.createDataFrame([], "index long, term string")
    for block in range(blocks):
        found = _block_sums(held, own(lists, block), min_df, block, parts)
        if found is not None:
            sums, vocabulary = sums.union(found[0]), vocabulary.union(found[1])
    return sums, vocabulary


def share(n: str, total: str, size: str = "v") -> Column:
    """p of a count in a group with ``total`` occurrences of ``size`` kept terms."""
    return F.expr(f"1 + ({ONE} * ({n} + 1)) div ({total} + {size})")


def gap(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pair_values(group: np.ndarray, term: np.ndarray, n: np.ndarray, size: np.ndarray) -> np.ndarray:
    """What some terms add to every pair of groups of a language, beside what terms of no group add."""
    none = 1 + ONE // size  # p of a count of 0, by group
    order = np.argsort(group, kind="stable")
    group, term = group[order], term[order]
    p = 1 + ONE * (n[order] + 1) // size[group]
    held, first = np.unique(group, return_index=True)
    ends = np.append(first[1:], len(group))
    values = np.zeros((len(size), len(size)), np.int64)
    own = {int(g): slice(a, b) for g, a, b in zip(held, first, ends)}
    q = np.empty(term.max() + 1, np.int64)
    for h in range(len(size)):
        q[:] = none[h]
        if h in own:
            q[term[own[h]]] = p[own[h]]
            # equal counts give equal numbers
            there, often = np.unique(p[own[h]], return_counts=True)
            values[:, h] = ((_gap(none[:, None], there) - _gap(none, none[h])[:, None]) * often).sum(axis=1)
        more = _gap(p, q[term]) - _gap(none[group], q[term])
        values[held, h] += np.add.reduceat(more, first)
    return values


def _term_values(group: np.ndarray, term: np.ndarray, n: np.ndarray, size: np.ndarray, lang_size: int, ranks: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries of terms that a group uses more than its language, and their values.

    Of each group those that can be among its first ``ranks``, ties at the last rank included. Entries are by term.
    """
    lang_n = np.add.reduceat(n, np.unique(term, return_index=True)[1])
    if lang_n.max() >= 2**63 // ONE - 1:
        raise OverflowError("a term occurs too often for whole numbers of 64 bits")
    p, q = 1 + ONE * (n + 1) // size[group], (1 + ONE * (lang_n + 1) // lang_size)[term]
    entry = np.flatnonzero(p > q)
    value = _gap(p[entry], q[entry])
    order = np.argsort(group[entry], kind="stable")
    entry, value = entry[order], value[order]
    ends = [*np.unique(group[entry], return_index=True)[1].tolist(), len(entry)]
    kept = np.ones(len(entry), bool)
    for a, b in zip(ends, ends[1:]):
        if b - a > ranks:
            kept[a:b] = value[a:b] >= np.partition(value[a:b], b - a - ranks)[b - a - ranks]
    return entry[kept], value[kept]


def values_of(sums: DataFrame, groups: DataFrame, term_ranks: int) -> DataFrame:
    """``lang, source, item, index, value``: what the terms of a task add to a pair (``index`` is null), and terms
    that can be among the first (``item`` is null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[str, tuple[list[str], np.ndarray]] = {}

        def rows(lang: str, source: list, item: list, index: list, value: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array([lang] * len(value), pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(index, pa.int64()), pa.array(value)]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "index", "value"])

        for batch in batches:
            for lang, sources, source, index, n, names, totals, v, lang_total in zip(*batch.columns):
                lang, names, v, lang_total = lang.as_py(), names.as_py(), v.as_py(), lang_total.as_py()
                number = {name: k for k, name in enumerate(names)}
                group = np.array([number[name] for name in sources.as_py()], np.int64)[source.values.to_numpy()]
                index, n = index.values.to_numpy(), n.values.to_numpy()
                term = np.unique(index, return_inverse=True)[1]
                size = totals.values.to_numpy() + v
                values = _pair_values(group, term, n, size)
                pairs[lang] = (names, pairs[lang][1] + values if lang in pairs else values)
                entry, value = _term_values(group, term, n, size, lang_total + v, term_ranks)
                yield rows(lang, [names[k] for k in group[entry].tolist()], [None] * len(entry), index[entry], value)
        for lang, (names, values) in pairs.items():
            a, b = np.nonzero(~np.eye(len(names), dtype=bool))
            yield rows(lang, [names[k] for k in a.tolist()], [names[k] for k in b.tolist()], [None] * len(a), values[a, b])

    by_lang = groups.filter("v > 0").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("own"), F.max("v").alias("v"), F.max("lang_total").alias("lang_total"))
    by_lang = by_lang.select("lang", F.col("own.source").alias("names"), F.col("own.total").alias("group_totals"), F.col("v").alias("lang_v"), "lang_total")
    counts = sums.select("lang", "sources", "source", "index", "n").join(F.broadcast(by_lang), "lang")
    return counts.mapInArrow(run, "lang string, source string, item string, index long, value long")


def _from_last_step(terms: DataFrame, ranks: int) -> DataFrame:
    """``terms`` without those whose value is certainly behind the first ``ranks`` of their group.

    Values are counted in steps that grow with them; the step that holds the last rank stays whole. So no task
    sorts all terms of a group.
    """
    step = F.floor(F.log2(F.col("value") + 1) * STEPS)
    counts = terms.groupBy("lang", "source", step.alias("step")).agg(F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("lang", "source").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("above", F.coalesce(F.sum("held").over(before), F.lit(0))).filter(F.col("above") < ranks)
    last = counts.groupBy("lang", "source").agg(F.min("step").alias("last"))
    return terms.join(last, ["lang", "source"]).filter(step >= F.col("last")).drop("last")


def divergence(docs: DataFrame, min_df: int = MIN_DF, term_ranks: int = TERM_RANKS, block_terms: int = BLOCK_TERMS, block_counts: int = BLOCK_COUNTS) -> DataFrame:
    """``lang, source, part, item, value, rank``: sources of a language by how far a group is from them (``pair``), and
    terms that a group uses more than its language by how much (``term``, the first ``term_ranks``)."""
    groups = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums, vocabulary = group_sums(docs, min_df, block_terms, block_counts)
    totals = sums.select("lang", F.explode(F.arrays_zip("sources", "totals")).alias("own"))
    totals = totals.groupBy("lang", F.col("own.sources").alias("source")).agg(F.sum("own.totals").alias("total"))
    total_of = F.aggregate("totals", F.lit(0).cast("long"), lambda a, b: a + b)
    langs = sums.groupBy("lang").agg(F.sum("v").alias("v"), F.sum(total_of).alias("lang_total"))
    zero = F.lit(0).cast("long")
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = materialize(groups.select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "v", "lang_total")]), "divergence-groups")

    values = materialize(values_of(sums, groups, term_ranks), "divergence-values")
    parts = values.filter("index IS NULL").groupBy("lang", "source", "item").agg(F.sum("value").alias("part_value"))
    own = groups.select("lang", "source", "v", F.when(F.col("v") > 0, share("0L", "total")).alias("p"))
    other = groups.select("lang", F.col("source").alias("item"), F.when(F.col("v") > 0, share("0L", "total")).alias("q"))
    pairs = own.join(other, "lang").filter("source <> item").join(parts, ["lang", "source", "item"], "left")
    value = F.coalesce(F.col("v") * gap("p", "q") + F.coalesce("part_value", zero), zero)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))

    terms = values.filter("index IS NOT NULL").select("lang", "source", "index", "value")
    # names are looked up only for what can be in the ranks: ties at the last rank are all kept here
    largest = Window.partitionBy("lang", "source").orderBy(F.col("value").desc())
    terms = _from_last_step(terms, term_ranks)
    terms = terms.withColumn("at", F.rank().over(largest)).filter(F.col("at") <= term_ranks).join(vocabulary, "index")
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

    by_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = terms.withColumn("rank", F.row_number().over(by_group)).filter(F.col("rank") <= term_ranks)
    return pairs.withColumn("rank", F.row_number().over(by_group)).union(terms)
