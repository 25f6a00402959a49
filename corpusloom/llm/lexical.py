"""Ranked lexical search for a stated set of items, by a search of two trees at once.

Terms are maximal runs of characters that are ASCII letters, ASCII digits or not ASCII; only A-Z are lower-cased. With N
documents that have a term and L terms in all of them, a term in df documents weighs ``w = floor(1000 ln((2N+2)/(2df+1)))``,
and a document of n terms, tf of them this one, scores ``w * ((10^9 tf) div (1000 tf + 12 m))`` for every occurrence of
it in the item, where ``m = 75 + (25 n N) div L``. All of it is in integers but the logarithm.

Only terms of items count for a score, so one pass over the texts writes a row of item terms per document, from
which N, L and df are summed. Every task then takes its documents in shards. A shard's documents are the leaves of a
tree, and so are the items: neighbours share their heaviest term, a node holds per term the largest value below
it. The product of two nodes is a bound on every score between them, equal to the score at the leaves. A pair of nodes
whose bound is less than the weakest k-th score that the items of the one have so far is left out with all below
it; others are replaced by the pairs of their children. A score equal to the k-th is kept for the sake of ties. Scores stay with
a task from shard to shard; what is best in a task is then merged by item in two steps. Nothing is approximated.

Items are read in blocks of bounded size (``MAX_CELLS`` numbers), each a search of its own; rows are never capped.

Null texts have no terms and are neither ranked nor counted; an item without terms has no rows. Null ids rank behind all
others of the same score. Repeated documents are ranked as documents of their own, repeated items as items of their own.
Empty tables give no rows; other columns, whatever their names, are left out.
"""

from __future__ import annotations

import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.common import materialize, texts_of

TOP = 20
# Numbers in the table of items by terms that a task holds; a block always has an item.
MAX_CELLS = 2_000_000
# Documents of one tree, and children of a node of either tree.
SHARD_DOCS = 4096
FAN = 16
ITEM_FAN = 8
# No weight of a term is multiplied by more.
MOST_FACTOR = 1_000_000
# Parts in which the best rows of an item are merged first.
MERGE_PARTS = 64

# Letters lower-cased and all that is not part of a term made a space; bytes from 128 on belong to terms.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def item_blocks(items: DataFrame, max_cells: int = MAX_CELLS) -> Iterator[list[tuple[object, Counter]]]:
    """The items that have terms, with their terms, in blocks; one block is in memory at a time."""
    block: list[tuple[object, Counter]] = []
    met: set[bytes] = set()
    for item_id, text in texts_of(items, "item_id").toLocalIterator():
        counts = Counter(terms_of(text.encode()))
        if not counts:
            continue
        if block and (len(block) + 1) * len(met.union(counts)) > max_cells:
            yield block
            block, met = [], set()
        block.append((item_id, counts))
        met.update(counts)
    if block:
        yield block


def term_rows(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, tf`` of every document with a term: how often it has which terms of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {term: k for k, term in enumerate(vocabulary)}.get
        size = len(vocabulary)
        for batch in batches:
            n, found = np.zeros(len(batch), np.int64), [np.zeros(0, np.int64)]
            for k, text in enumerate(batch.column("text")):
                words = terms_of(text.as_buffer().to_pybytes())
                n[k] = len(words)
                ids = np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))
                found.append(ids[ids >= 0] + k * size)
            cells, tf = np.unique(np.concatenate(found), return_counts=True)
            ends = np.searchsorted(cells, np.arange(len(batch) + 1) * size).astype(np.int32)
            terms = pa.ListArray.from_arrays(pa.array(ends), pa.array((cells % size).astype(np.int32)))
            counts = pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int64)))
            rows = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), terms, counts], names=["doc_id", "n", "terms", "tf"])
            yield rows.filter(pa.array(n > 0))

    texts = texts_of(docs).withColumn("text", F.col("text").cast("binary"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {id_type}, n long, terms array<int>, tf array<long>")


def document_frequencies(rows: DataFrame, size: int) -> np.ndarray:
    """How many rows hold each term; summed per task before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).toLocalIterator():
        out[term] = df
    return out


class Items:
    """The tree of a block's items: weights per item and term, and their maxima per group and group of groups."""

    def __init__(self, counts: list[Counter], vocabulary: list[bytes], weights: np.ndarray):
        place = {term: k for k, term in enumerate(vocabulary)}
        table = np.zeros((len(counts), len(vocabulary)), np.int64)
        for k, c in enumerate(counts):
            own = np.array([place[t] for t in c], np.int64)
            table[k, own] = weights[own] * np.array(list(c.values()), np.int64)
        self.order = np.lexsort((table.max(axis=1), table.argmax(axis=1)))  # place in the tree -> item
        leaves = table[self.order]
        groups = np.maximum.reduceat(leaves, np.arange(0, len(leaves), ITEM_FAN))
        top = np.maximum.reduceat(groups, np.arange(0, len(groups), ITEM_FAN))
        # sums of whole numbers below 2^53 are exact in floating point, in whatever order they are added
        kind = np.float64 if int(top.sum(axis=1).max()) * MOST_FACTOR < 1 << 53 else np.int64
        self.levels = [np.ascontiguousarray(t.T, kind) for t in (top, groups, leaves)]  # terms by nodes, from the root down

    def children(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """The nodes of ``level`` below nodes of the level before."""
        below = (nodes[:, None] * ITEM_FAN + np.arange(ITEM_FAN)).ravel()
        return below[below < self.levels[level].shape[1]]


class Rows:
    """Sparse rows: ``terms`` and ``values`` of row k lie between ``ends[k]`` and ``ends[k + 1]``."""

    def __init__(self, terms: np.ndarray, values: np.ndarray, ends: np.ndarray):
        self.terms, self.values, self.ends = terms, values, ends

    def __len__(self) -> int:
        return len(self.ends) - 1

    def row(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        return self.terms[self.ends[k] : self.ends[k + 1]], self.values[self.ends[k] : self.ends[k + 1]]

    def taken(self, order: np.ndarray) -> Rows:
        """Rows in another order."""
        n = np.diff(self.ends)[order]
        ends = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.ends[order] - ends[:-1], n) + np.arange(ends[-1])
        return Rows(self.terms[at], self.values[at], ends)

    def parents(self, size: int) -> Rows:
        """Per ``FAN`` rows side by side one with the largest value of every term; ``size`` is the number of terms."""
        row = np.repeat(np.arange(len(self)) // FAN, np.diff(self.ends))
        cell = row * size + self.terms
        order = np.argsort(cell, kind="stable")
        cell, first = np.unique(cell[order], return_index=True)
        values = np.maximum.reduceat(self.values[order], first) if len(first) else self.values
        return Rows(cell % size, values, np.searchsorted(cell, np.arange(-(-len(self) // FAN) + 1) * size))


class Search:
    """The best rows of every item so far, in one task."""

    def __init__(self, items: Items, weights: np.ndarray, top: int):
        self.items, self.weights, self.top = items, weights, top
        self.best: list[list[tuple]] = [[] for _ in items.order]  # (-score, no id, id) by place in the tree
        self.pairs = 0  # pairs of a document and an item that were scored

        self.weakest = [np.ones(level.shape[1], level.dtype) for level in items.levels]

    def shard(self, ids: list, docs: Rows) -> None:
        """Search documents whose values are the factors that go with the weights of their terms."""
        size = len(self.weights)
        heavy = [int(t[np.argmax(v * self.weights[t])]) if len(t) else -1 for t, v in map(docs.row, range(len(docs)))]
        order = np.argsort(np.array(heavy), kind="stable")
        self.ids, self.docs = [ids[k] for k in order], docs.taken(order)
        self.leaves = self.docs.parents(size)
        self.tops = self.leaves.parents(size)
        root = np.arange(self.items.levels[0].shape[1])
        bounds = np.stack([self._bounds(self.tops, k, 0, root) for k in range(len(self.tops))])
        for k in np.argsort(-bounds.max(axis=1), kind="stable"):
            alive = root[bounds[k] >= self.weakest[0]]
            if len(alive):
                self._descend(int(k), self.items.children(1, alive))

    def _bounds(self, rows: Rows, k: int, level: int, nodes: np.ndarray) -> np.ndarray:
        terms, values = rows.row(k)
        table = self.items.levels[level]
        if len(nodes) < table.shape[1]:
            return values.astype(table.dtype) @ table[np.ix_(terms, nodes)]
        return values.astype(table.dtype) @ table[terms]

    def _descend(self, top: int, groups: np.ndarray) -> None:
        for leaf in range(top * FAN, min(len(self.leaves), (top + 1) * FAN)):
            bounds = self._bounds(self.leaves, leaf, 1, groups)
            alive = groups[bounds >= self.weakest[1][groups]]
            if len(alive):
                items = self.items.children(2, alive)
                items = items[self._bounds(self.leaves, leaf, 2, items) >= self.weakest[2][items]]
                for doc in range(leaf * FAN, min(len(self.docs), (leaf + 1) * FAN)) if len(items) else ():
                    self._score(doc, items)

    def _score(self, doc: int, items: np.ndarray) -> None:
        scores = self._bounds(self.docs, doc, 2, items)
        self.pairs += len(items)
        for k in np.flatnonzero(scores >= self.weakest[2][items]).tolist():
            item, doc_id = int(items[k]), self.ids[doc]
            best = self.best[item]
            insort(best, (-int(scores[k]), doc_id is None, doc_id if doc_id is not None else 0))
            if len(best) > self.top:
                best.pop()
            if len(best) == self.top and -best[-1][0] > self.weakest[2][item]:
                self._raise(item, -best[-1][0])

    def _raise(self, item: int, score: int) -> None:
        """The k-th score of an item has risen; so may the weakest of its group."""
        self.weakest[2][item] = score
        for level in (1, 0):
            group = item // ITEM_FAN
            low = self.weakest[level + 1][group * ITEM_FAN : (group + 1) * ITEM_FAN].min()
            if low == self.weakest[level][group]:
                return
            self.weakest[level][group] = low
            item = group

    def rows(self) -> Iterator[tuple[int, object, int]]:
        for place, best in zip(self.items.order.tolist(), self.best):
            for score, no_id, doc_id in best:
                yield place, None if no_id else doc_id, -score


def factors(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    m = 75 + (25 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _search_block(rows: DataFrame, counts: list[Counter], vocabulary: list[bytes], weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    id_type = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(Items(counts, vocabulary, weights), weights, top)
        for batch in batches:
            for start in range(0, len(batch), SHARD_DOCS):
                part = batch.slice(start, SHARD_DOCS)
                terms = part.column("terms")
                ends = terms.offsets.to_numpy().astype(np.int64)
                n = np.repeat(part.column("n").to_numpy(), np.diff(ends))
                values = factors(part.column("tf").flatten().to_numpy(), n, n_docs, n_terms)
                search.shard(part.column("doc_id").to_pylist(), Rows(terms.flatten().to_numpy().astype(np.int64), values, ends - ends[0]))
        best = list(search.rows())
        columns = zip((pa.int64(), arrow_id, pa.int64()), zip(*best) if best else ([], [], []))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for t, c in columns], names=["item_no", "doc_id", "score"])

    schema = T.StructType([T.StructField("item_no", T.LongType()), T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    return rows.mapInArrow(run, schema)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, max_cells: int = MAX_CELLS) -> DataFrame:
    """``item_id, rank, doc_id, score``: every item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType
    numbers = T.StructType([T.StructField("item_no", T.LongType()), T.StructField("item_id", item_type)])
    out = spark.createDataFrame([], f"item_id {item_type.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    for block in item_blocks(items, max_cells):
        counts = [c for _, c in block]
        vocabulary = sorted(set().union(*counts))
        rows = materialize(term_rows(docs, vocabulary), "lexical-terms")
        n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            continue
        df = document_frequencies(rows, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        found = _search_block(rows, counts, vocabulary, weights, n_docs, n_terms, top)
        order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        parts = Window.partitionBy("item_no", "part").orderBy(*order)
        found = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_PARTS)))
        found = found.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= top)
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_no").orderBy(*order))).filter(F.col("rank") <= top)
        names = spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(block)], numbers)
        out = out.union(found.join(F.broadcast(names), "item_no").select("item_id", "rank", "doc_id", "score"))
    return out
