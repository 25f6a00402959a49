"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every row has a cell on a ring of 2^14 cells, from the md5 of its key; every shard has ``vnodes`` virtual nodes in
cells of the same ring. Rows are taken in ring order. A row belongs to the first virtual node at or after its cell;
when that node's shard is full it continues clockwise to the next shard that is not. Shards hold the same number
of rows, or one more, so counts are at most one apart (the law ``rows``), and only rows that overflow move away from
where plain consistent hashing puts them.

Rows of equal cells follow each other, so each shard's share of the ring is a few ranges of ring ranks. What the
ranges are follows from the number of rows per cell alone: at most 2^14 numbers, whatever the table holds. A row's
rank is the count of all rows before its cell plus its place in the cell. A cell with very many rows, as of one key
repeated over and over, is numbered in parts of about ``PART_ROWS`` rows. All work on rows is DataFrame functions.

The key is the text of doc_id (null: empty). Null texts have no bytes. Repeated rows are rows of their own; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import materialize, prefix_sums

BITS = 14
CELLS = 1 << BITS
VNODES = 64
PART_ROWS = 1_000_000
RECORD_BYTES = 8


def cell_of(key: Column) -> Column:
    """The first 14 bits of the md5 of a key."""
    return F.shiftright(F.conv(F.substring(F.md5(key.cast("binary")), 1, 4), 16, 10).cast("int"), 16 - BITS)


def node_cell(shard: int, vnode: int) -> int:
    return int(hashlib.md5(f"shard {shard} node {vnode}".encode()).hexdigest()[:4], 16) >> (16 - BITS)


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """``(cell, shard)`` of all virtual nodes in ring order."""
    return sorted((node_cell(s, v), s) for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def ranges(counts: list[int], shards: int, vnodes: int = VNODES) -> list[tuple[int, int, int, int]]:
    """``(first rank, end rank, shard, slot of the first)``: where rows of the ring go, from the rows per cell."""
    nodes = ring(shards, vnodes)
    cells = [cell for cell, _ in nodes]
    arcs = [0] * len(nodes)
    for cell, n in enumerate(counts):
        arcs[bisect_left(cells, cell) % len(nodes)] += n
    # ring order starts behind the last node: its arc goes on at the first cell
    wrapped = sum(counts[cells[-1] + 1 :])
    room, used = capacities(sum(counts), shards), [0] * shards
    out, rank = [], 0
    pieces = [(0, arcs[0] - wrapped)] + [(k, n) for k, n in enumerate(arcs)][1:] + [(0, wrapped)]
    for node, n in pieces:
        at = node
        while n:
            shard = nodes[at % len(nodes)][1]
            take = min(n, room[shard] - used[shard])
            if take:
                out.append((rank, rank + take, shard, used[shard]))
                used[shard] += take
                rank += take
                n -= take
            at += 1
    return out


def ring_shards(docs: DataFrame, shards: int = 24, vnodes: int = VNODES, part_rows: int = PART_ROWS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; slots are gapless from 0 in each shard."""
    spark = docs.sparkSession
    text = F.coalesce(docs["text"], F.lit("")).cast("binary")
    rows = docs.select(
        docs["doc_id"],
        (F.octet_length(text) + RECORD_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        cell_of(F.coalesce(docs["doc_id"].cast("string"), F.lit(""))).alias("cell"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "ring-rows")  # numbers of rows stay what they are, whoever is lost
    cells = materialize(rows.groupBy("cell").agg(F.count("*").alias("n")), "ring-cells")  # at most 2^14
    per_cell = {r["cell"]: r["n"] for r in cells.collect()}
    counts = [per_cell.get(c, 0) for c in range(CELLS)]
    parts = F.expr(f"(n + {part_rows - 1}) div {part_rows}")
    rows = rows.join(F.broadcast(cells.select("cell", parts.alias("parts"))), "cell")
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    sizes = rows.groupBy("cell", "part").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("place", F.struct("cell", "part"))
    sizes = prefix_sums(sizes, "place", "n", "before", F.expr("cell div 256")).select("cell", "part", "before")
    within = Window.partitionBy("cell", "part").orderBy("doc_id", "text_crc32", "size", "row")
    ranked = rows.withColumn("at", F.row_number().over(within) - 1).join(sizes, ["cell", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("at"))
    return _placed(spark, ranked, counts, shards, vnodes).select("doc_id", "size", "text_crc32", "shard", "slot")


def _placed(spark, ranked: DataFrame, counts: list[int], shards: int, vnodes: int) -> DataFrame:
    """Look up the range of every rank. Ranges are spread over the cells they touch, at most one more than cells and ranges."""
    first = [0]
    for n in counts:
        first.append(first[-1] + n)
    found = []
    for start, end, shard, slot in ranges(counts, shards, vnodes):
        low = bisect_left(first, start + 1) - 1
        high = bisect_left(first, end) - 1
        found.append((low, high, start, end, shard, slot))
    values = ", ".join(f"({a}, {b}, {c}L, {d}L, {e}, {f}L)" for a, b, c, d, e, f in found) or "(0, 0, 0L, 0L, 0, 0L)"
    table = spark.sql(f"SELECT explode(sequence(low, high)) AS cell, first, end, shard, slot_base FROM VALUES {values} AS t(low, high, first, end, shard, slot_base)")
    joined = ranked.join(F.broadcast(table), ["cell"])
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    return joined.filter(inside).withColumn("slot", F.col("slot_base") + F.col("rank") - F.col("first"))
