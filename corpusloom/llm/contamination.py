"""Benchmark decontamination with an FM-index over each shard of the training texts.

Every task indexes its documents shard by shard. All test phrases are searched backwards through the ranks of a
wavelet matrix, their occurrences are located by walking to sampled suffix positions, and the hit words merge
into spans to remove.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. A phrase is a window of
``width`` consecutive words of an item; an item of fewer words, but not none, is one phrase. Only runs of words
that phrases know, as long as the shortest phrase, enter the index: a word outside the vocabulary of the phrases
ends every possible occurrence. Null and empty texts have no words; an item without words has no phrase; repeated
rows and tied ids each give their own row; null item ids are no items.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import texts_of

WIDTH = 13
# Words of a shard; a longer document is a shard of its own.
SHARD_WORDS = 1_000_000
# Every so many positions of a shard one keeps its place in the suffix order.
SAMPLE_EVERY = 8
# Words of test items that travel to the tasks at once; larger sets are searched block by block.
MAX_ITEM_WORDS = 2_000_000

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


class Phrases:
    """The distinct windows of a block of items, as numbers of words, grouped by length."""

    def __init__(self, items: list[tuple[str, str]], width: int = WIDTH):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            words = words_of(text)
            ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                windows.setdefault(ids[i : i + width], set()).add(item_id)
        self.by_length: dict[int, tuple[np.ndarray, list[list[str]]]] = {}
        for length in sorted({len(w) for w in windows}):
            some = [w for w in windows if len(w) == length]
            self.by_length[length] = (np.array(some, np.int64), [sorted(windows[w]) for w in some])
        self.shortest = min(self.by_length, default=0)


class WaveletMatrix:
    """Rank of any symbol in a sequence: one level of bits for every bit of a symbol."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits, self.levels = max(1, int(n_symbols - 1).bit_length()), []
        for bit in reversed(range(self.bits)):
            ones = (symbols >> bit & 1).astype(bool)
            zeros = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((zeros, int(zeros[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        every = np.arange(n_symbols)
        self.starts = self._down(every, np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        for level, (zeros, n_zeros) in enumerate(self.levels):
            one = (symbols >> (self.bits - 1 - level) & 1).astype(bool)
            ends = np.where(one, n_zeros + ends - zeros[ends], zeros[ends])
        return ends

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        return self._down(symbols, ends) - self.starts[symbols]


def suffix_order(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The suffix array of runs, each closed by its own smallest symbol, by doubling of compared lengths."""
    n = len(symbols)
    rank = symbols.copy()
    rank[ends] = np.arange(len(ends))
    rank[symbols != 0] += len(ends)
    step = 1
    order = np.argsort(rank, kind="stable")
    rank = _renumber(rank, order)
    while rank.max(initial=0) < n - 1:
        following = np.zeros(n, np.int64)
        following[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + following
        order = np.argsort(key, kind="stable")
        rank = _renumber(key, order)
        step *= 2
    return order


def _renumber(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    sorted_key = key[order]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])]) if len(key) else sorted_key
    return rank


class FmIndex:
    """Backward search and location over runs of word numbers (1 and up), each run followed by a 0."""

    def __init__(self, symbols: np.ndarray, n_symbols: int, sample_every: int = SAMPLE_EVERY):
        ends = np.flatnonzero(symbols == 0)
        order = suffix_order(symbols, ends)
        before = symbols[order - 1]  # position 0 looks at the last symbol, a 0
        self.matrix = WaveletMatrix(before, n_symbols + 1)
        counts = np.bincount(symbols, minlength=n_symbols + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.before = before
        starts = np.zeros(len(symbols), bool)
        starts[0] = True
        starts[ends[:-1] + 1] = True  # a walk never has to cross the end of a run
        self.sampled = starts[order] | (order % sample_every == 0)
        self.samples = order[self.sampled]
        self.sample_no = np.cumsum(self.sampled) - 1

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For rows of word numbers of one length the ranges of their suffixes, all searched at once."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), len(self.before), np.int64)
        alive = np.arange(len(phrases))
        for k in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, k]
            lo[alive] = self.first[symbol] + self.matrix.rank(symbol, lo[alive])
            hi[alive] = self.first[symbol] + self.matrix.rank(symbol, hi[alive])
            alive = alive[lo[alive] < hi[alive]]
        hi = np.maximum(lo, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: step to the one before until a sampled one is met."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        open_rows = np.flatnonzero(~self.sampled[at])
        while len(open_rows):
            symbol = self.before[at[open_rows]]
            at[open_rows] = self.first[symbol] + self.matrix.rank(symbol, at[open_rows])
            steps[open_rows] += 1
            open_rows = open_rows[~self.sampled[at[open_rows]]]
        return self.samples[self.sample_no[at]] + steps


def _known_runs(ids: np.ndarray, shortest: int) -> np.ndarray:
    """Starts and ends of runs of known words that can hold a phrase."""
    known = np.concatenate([[0], (ids != 0).view(np.int8), [0]])
    change = np.diff(known)
    runs = np.stack([np.flatnonzero(change == 1), np.flatnonzero(change == -1)], axis=1)
    return runs[runs[:, 1] - runs[:, 0] >= shortest]


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], list[str]]]:
    """For every document (as word numbers, 0 for words no phrase has) its hit spans and its items."""
    pieces, where, base = [], [], 0
    for d, ids in enumerate(docs):
        for start, end in _known_runs(ids, phrases.shortest):
            pieces += [ids[start:end], np.zeros(1, np.int64)]
            where.append((base, d, start))
            base += end - start + 1
    out: list[tuple[list, set]] = [([], set()) for _ in docs]
    if pieces:
        index = FmIndex(np.concatenate(pieces), len(phrases.vocabulary))
        run_at = np.array(where, np.int64)
        found = []
        for length, (windows, items) in phrases.by_length.items():
            lo, hi = index.search(windows)
            n = hi - lo
            which = np.repeat(np.arange(len(windows)), n)
            if not len(which):
                continue
            rows = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            position = index.locate(rows)
            run = np.searchsorted(run_at[:, 0], position, side="right") - 1
            doc = run_at[run, 1]
            start = run_at[run, 2] + position - run_at[run, 0]
            found.append(np.stack([doc, start, start + length], axis=1))
            for d, w in np.unique(np.stack([doc, which], axis=1), axis=0):
                out[d][1].update(items[w])
        if found:
            hits = np.concatenate(found)
            hits = hits[np.lexsort((hits[:, 1], hits[:, 0]))]
            for d, group in itertools.groupby(hits.tolist(), key=lambda hit: hit[0]):
                out[d][0].extend(merged([(start, end) for _, start, end in group]))
    return [(spans, sorted(items)) for spans, items in out]


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _found(texts: list[str], phrases: Phrases) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
    """Words, hit spans and items of every text, searched shard by shard."""
    get = phrases.vocabulary.get
    counts, results, shard, size = [], [], [], 0
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        shard.append(np.fromiter((get(w, 0) for w in words), np.int64, len(words)))
        size += len(words)
        if size >= SHARD_WORDS:
            results += search_shard(shard, phrases)
            shard, size = [], 0
    results += search_shard(shard, phrases)
    return counts, [spans for spans, _ in results], [items for _, items in results]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def item_blocks(benchmark: DataFrame, max_words: int = MAX_ITEM_WORDS) -> list[list[tuple[str, str]]]:
    """The distinct test items, ids as strings, in blocks of a bounded number of words.

    A stated set of test items is read one by one; every block is a pass of its own over a shard's index.
    """
    items = texts_of(benchmark, "item_id").filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("string"), "text").distinct()
    blocks: list[list[tuple[str, str]]] = [[]]
    size = 0
    for item_id, text in items.orderBy("doc_id", "text").toLocalIterator():
        n = len(words_of(text))
        if size and size + n > max_words:
            blocks.append([])
            size = 0
        blocks[-1].append((item_id, text))
        size += n
    return blocks


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, max_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """For every document ``doc_id, n_words, spans`` (hit words, end exclusive, merged) and ``items`` (sorted).

    Nothing is shuffled. Items beyond ``max_words`` words are searched in further passes whose spans and items
    are merged into the same row.
    """
    return _searched(texts_of(docs), "text", benchmark, ("n_words", "spans", "items"), width, max_words).drop("text")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows of ``docs``, all columns, that the contamination rule does not reject."""
    tag = uuid.uuid4().hex  # no column of docs has such a name
    names = (f"n_words_{tag}", f"spans_{tag}", f"items_{tag}")
    found = _searched(docs, text_col, benchmark, names, width, MAX_ITEM_WORDS)
    return found.filter(~contaminated(names[1], names[0])).select(*docs.columns)


def _searched(docs: DataFrame, text_col: str, benchmark: DataFrame, names: tuple[str, str, str], width: int, max_words: int) -> DataFrame:
    """``docs`` with three more columns: words, spans and items of every text."""
    none = (F.lit(0).cast("long"), F.expr("cast(array() AS array<struct<start:long,end:long>>)"), F.expr("cast(array() AS array<string>)"))
    out = docs.withColumns(dict(zip(names, none)))
    for items in item_blocks(benchmark, max_words):
        out = out.mapInArrow(_pass(items, width, text_col, names), out.schema)
    return out


def _pass(items: list[tuple[str, str]], width: int, text_col: str, names: tuple[str, str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = Phrases(items, width)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            counts, spans, found = _found([t or "" for t in columns[text_col].to_pylist()], phrases)
            earlier = [[(s["start"], s["end"]) for s in old] for old in columns[names[1]].to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in merged(old + new)] for old, new in zip(earlier, spans)]
            found = [sorted({*old, *new}) for old, new in zip(columns[names[2]].to_pylist(), found)]
            columns |= {names[0]: pa.array(counts, pa.int64()), names[1]: pa.array(spans, _SPANS), names[2]: pa.array(found, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def hit_words(spans: str = "spans") -> Column:
    """Words inside the spans of a row."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])


def contaminated(spans: str = "spans", n_words: str = "n_words") -> Column:
    """The contamination rule: hit words make up a twentieth of the text or more."""
    return (hit_words(spans) > 0) & (20 * hit_words(spans) >= F.col(n_words))
