"""Pack token sequences of documents into as few fixed-length sequences as possible.

A document longer than ``size`` is cut so that only its first piece may be shorter; full pieces are sequences of
their own. The first pieces are packed in groups of some ten thousand, each in one task: best fit by decreasing
length, then a local search among the bins that are not full. It takes the fullest of them and moves a document
of an emptier bin into it, or exchanges one of its documents for a longer one, or for two that are longer together.
Every step adds to the sum of squared fills, so the search ends, with bins emptied on the way.

The emptiest tenth of each group's bins goes on to a next round with fewer groups, until one group is left, so
all groups together waste about what one would. No round holds more than a group in a task.

Null texts are empty and make a piece of one end id. Repeated rows and tied ids are packed as rows of their own;
an empty table gives no sequences. The sequences depend on the groups, which depend on the ids and the number of
rows only.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, texts_of
from corpusloom.llm.encoding import END_ID, encoder

SIZE = 2048
GROUP_ROWS = 16_384
# One in so many bins of a group, the emptiest, is packed again with those of other groups.
CARRY = 10
# Pieces of texts that a worker remembers, and bytes of text that it encodes at once: less than the encoder would, since
# packing is the last step of chains whose JVMs have grown before.
KEPT_PIECES = 200_000
STEP_BYTES = 1_000_000


class Bins:
    """Bins of one group: which items each holds and how much room is left."""

    def __init__(self, lengths: list[int], size: int = SIZE):
        self.size, self.lengths = size, lengths
        self.items: list[list[int]] = []
        self.room: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that has room; bins are found by a bit for every amount of room."""
        by_room: list[list[int]] = [[] for _ in range(self.size + 1)]
        mask = 0
        for item in sorted(range(len(self.lengths)), key=self.lengths.__getitem__, reverse=True):
            n = self.lengths[item]
            fitting = mask >> n
            if fitting:
                room = n + (fitting & -fitting).bit_length() - 1
                k = by_room[room].pop()
                if not by_room[room]:
                    mask &= ~(1 << room)
                self.items[k].append(item)
            else:
                k, room = len(self.items), self.size
                self.items.append([item])
                self.room.append(room)
            left = self.room[k] = room - n
            by_room[left].append(k)
            mask |= 1 << left

    def improve(self) -> None:
        """Fill the fullest bins from emptier ones while some step raises the sum of squared fills.

        A step moves an item into a bin with room, or exchanges an item for a longer one, or for two that are
        longer together. What goes in comes from a bin that is not fuller, so every step raises the sum and the
        search ends; the emptiest bins run empty. A step may bring lengths into a bin that others passed over
        before, so passes over all bins are repeated until one makes no step: then no bin has one.
        """
        self.by_length: dict[int, set[int]] = defaultdict(set)  # length -> bins with an item of it
        self.by_pair: dict[int, set[int]] = defaultdict(set)  # length of two items -> bins that hold them
        for k, room in enumerate(self.room):
            if room:
                self._list(k, True)
        while self._pass():
            pass

    def _pass(self) -> int:
        """Take every bin that is not full, the fullest first, as often as it changes; the number of steps made."""
        waiting = [(room, k) for k, room in enumerate(self.room) if room and self.items[k]]
        heapq.heapify(waiting)
        steps = 0
        while waiting:
            room, k = heapq.heappop(waiting)
            if room != self.room[k] or not self.items[k]:
                continue  # changed since it was put here
            step = self._step(k)
            if step:
                other, take, give = step
                self._change(k, other, take, give)
                steps += 1
                for bin_no in (k, other):
                    if self.room[bin_no] and self.items[bin_no]:
                        heapq.heappush(waiting, (self.room[bin_no], bin_no))
        return steps

    def _list(self, k: int, add: bool) -> None:
        counts = Counter(self.lengths[i] for i in self.items[k])
        lengths = list(counts)
        for a, n in enumerate(lengths):
            (self.by_length[n].add if add else self.by_length[n].discard)(k)
            for m in lengths[a + 1 :] + ([n] if counts[n] > 1 else []):
                (self.by_pair[n + m].add if add else self.by_pair[n + m].discard)(k)

    def _change(self, k: int, other: int, take: list[int], give: list[int]) -> None:
        """Bin ``k`` takes items of ``other`` and gives it some of its own; full and empty bins are listed no more."""
        for bin_no, gone, new in ((k, give, take), (other, take, give)):
            self._list(bin_no, False)
            self.items[bin_no] = [i for i in self.items[bin_no] if i not in gone] + new
            self.room[bin_no] = self.size - sum(self.lengths[i] for i in self.items[bin_no])
            if self.room[bin_no]:
                self._list(bin_no, True)

    def _step(self, k: int) -> tuple[int, list[int], list[int]] | None:
        """What bin ``k`` takes from which bin and gives for it: what fills it most, moves before exchanges."""
        own = {self.lengths[i]: i for i in self.items[k]}
        for gain in range(self.room[k], 0, -1):
            other = self._emptier(self.by_length, gain, k)
            if other is not None:
                return other, [self._one(other, gain)], []
            for n, item in own.items():
                other = self._emptier(self.by_length, n + gain, k)
                if other is not None:
                    return other, [self._one(other, n + gain)], [item]
                other = self._emptier(self.by_pair, n + gain, k)
                if other is not None:
                    return other, self._two(other, n + gain), [item]
        return None

    def _emptier(self, table: dict[int, set[int]], length: int, k: int) -> int | None:
        found = table.get(length)
        if found:
            for other in found:
                if self.room[other] >= self.room[k] and other != k:
                    return other
        return None

    def _one(self, k: int, length: int) -> int:
        return next(i for i in self.items[k] if self.lengths[i] == length)

    def _two(self, k: int, length: int) -> list[int]:
        first: dict[int, int] = {}
        for i in self.items[k]:
            if length - self.lengths[i] in first:
                return [first[length - self.lengths[i]], i]
            first[self.lengths[i]] = i
        raise AssertionError("a listed pair is missing")


def pack(lengths: list[int], size: int = SIZE) -> list[list[int]]:
    """Item numbers by bin."""
    bins = Bins(lengths, size)
    bins.best_fit()
    bins.improve()
    return [items for items in bins.items if items]


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every encoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer, max_pieces=KEPT_PIECES, step_bytes=STEP_BYTES), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for some in own.each(batch.column("text")):
                rows = []
                for encoded, doc_id in zip(some, ids):
                    data = encoded + end
                    total = len(data) // 4
                    at, piece = 0, 0
                    while at < total:
                        n = size if at or total % size == 0 else total % size
                        rows.append((doc_id, piece, at, n, zlib.crc32(data[4 * at : 4 * (at + n)])))
                        at, piece = at + n, piece + 1
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PIECE_TYPES)], names=_PIECE_NAMES)
        own.forget()

    texts = texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
_ROW = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"


def _pack_group(size: int, last: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)  # whatever order the shuffle brought
        bins = pack(rows["length"].tolist(), size)
        lengths = rows["length"].to_numpy()
        fill = [int(lengths[items].sum()) for items in bins]
        order = sorted(range(len(bins)), key=lambda k: fill[k])
        carried = set() if last else set(order[: -(-len(bins) // CARRY)])
        number, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for k, items in enumerate(bins):
            number[items] = -1 if k in carried else k
            offset[items] = np.concatenate([[0], np.cumsum(lengths[items])[:-1]])
        return rows[_PIECE_NAMES + ["row"]].assign(bin=number, offset=offset, group=key[0])

    return run


def pack_pieces(pieces: DataFrame, size: int = SIZE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``size`` tokens; each piece is in one sequence."""
    pieces = materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")
    full = pieces.filter(F.col("length") >= size)
    # ids of three kinds of numbers: 0 full pieces by row, from 1 on the rounds of packing
    out = [full.select(*_PIECE_NAMES, (F.col("row") * 64).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    open_rows = pieces.filter(F.col("length") < size).select(*_PIECE_NAMES, "row")
    count, level = open_rows.count(), 1
    while count:
        groups = -(-count // group_rows)
        grouped = open_rows.withColumn("group", F.pmod(F.xxhash64("row", F.lit(level)), F.lit(groups)))
        packed = grouped.groupBy("group").applyInPandas(_pack_group(size, groups == 1), _ROW + ", bin long, offset long, group long")
        packed = materialize(packed, "packing-round")
        done = packed.filter("bin >= 0")
        sequence = (F.col("group") * F.lit(1 << 24) + F.col("bin")) * 64 + level
        out.append(done.select(*_PIECE_NAMES, sequence.alias("sequence_id"), "offset"))
        open_rows = packed.filter("bin < 0").select(*_PIECE_NAMES, "row")
        count = 0 if groups == 1 else open_rows.count()
        level += 1
    whole = out[0]
    for part in out[1:]:
        whole = whole.union(part)
    return whole


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document."""
    return pack_pieces(token_pieces(docs, tokenizer, size), size, group_rows)
