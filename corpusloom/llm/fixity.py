"""Fixity audit of WARC archives: Merkle trees over records, compared from the roots down.

A page becomes a WARC response record; an archive is a number of files of some five hundred records, a record's
file given by the md5 of its page id, its place by the order of page ids. A leaf hashes a record (SHA-256) and knows
its offset range; a node hashes the ranges and hashes of up to 16 nodes below it, in order; above the roots of files
the same goes on to one root of the archive.

Two replicas build their trees from their own bytes. The audit compares the roots and takes, level by level, only
the children of nodes that differ; at the leaves it matches the records of differing blocks by page id, so that
one lost record does not count all later ones of its file, which only moved, as damaged.

Null urls and pages are empty; null page ids form a record set of their own; repeated equal records are one leaf
with a count, so copies are collapsed before anything is brought together. The different records of one page id share
a file; they are numbered in 4,096 parts by their hash, so that id may hold any share of all rows. An empty archive has no
nodes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import materialize

FILE_RECORDS = 512
FANOUT = 16
# Hexadecimal digits of a record's hash that tell the parts in which the records of one page id are numbered.
PART_DIGITS = 3


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """The bytes of a response record."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def files_for(pages: DataFrame, file_records: int = FILE_RECORDS) -> int:
    """The number of files an archive of these pages has; replicas of it use the same number."""
    return max(1, -(-pages.count() // file_records))


def leaves(pages: DataFrame, files: int) -> DataFrame:
    """``page_id, file_no, place, first, last, copies, sha256``: every record with its offsets (end exclusive)."""
    record = warc_record(pages["page_id"], pages["url"], pages["html"])
    rows = pages.select(pages["page_id"], F.sha2(record, 256).alias("sha256"), F.octet_length(record).cast("long").alias("size"))
    rows = rows.groupBy("page_id", "sha256", "size").agg(F.count("*").alias("copies"))
    key = F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary"))
    rows = rows.withColumn("file_no", F.conv(F.substring(key, 1, 8), 16, 10).cast("long") % files)
    rows = materialize(rows.withColumn("part", F.substring("sha256", 1, PART_DIGITS)), "fixity-records")
    # two levels, so that no task sees all records of a page id: bytes and records before each part, then inside parts
    weight = F.col("size") * F.col("copies")
    part = ["file_no", "page_id", "part"]
    sums = rows.groupBy(*part).agg(F.sum(weight).alias("bytes"), F.count("*").alias("records"))
    before = Window.partitionBy("file_no").orderBy("page_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ("bytes", "records")]
    sums = sums.select(*[F.col(c).alias(f"_{c}") for c in part], *earlier)
    inside = Window.partitionBy(*part).orderBy("sha256")
    rows = rows.withColumns({"at": F.row_number().over(inside) - 1, "upto": F.sum(weight).over(inside)})
    rows = rows.join(sums, _same(rows, part))
    rows = rows.withColumns({"place": F.col("_records") + F.col("at"), "last": F.col("_bytes") + F.col("upto")})
    return rows.select("page_id", "file_no", "place", (F.col("last") - weight).alias("first"), "last", "copies", "sha256")


def _up(nodes: DataFrame, keys: list[str], number: str) -> DataFrame:
    """One level of nodes from the one below: ``number`` becomes the number of the block of ``FANOUT``."""
    child = F.struct(F.col(number), F.col("first"), F.col("last"), F.col("hash"))
    grouped = nodes.groupBy(*keys, F.expr(f"{number} div {FANOUT}").alias("up")).agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.array_sort(F.collect_list(child)).alias("below")
    )
    text = F.concat_ws(";", F.transform("below", lambda c: F.concat_ws(":", c["first"].cast("string"), c["last"].cast("string"), c["hash"])))
    return grouped.select(*keys, F.col("up").alias(number), "first", "last", F.sha2(text.cast("binary"), 256).alias("hash"))


class Tree:
    """The levels of an archive: records, blocks of records up to one root a file, then up to the root of all files."""

    def __init__(self, records: DataFrame, files: int, depth: int):
        self.leaves, self.in_files = records, depth
        level = self.leaves.select("file_no", F.col("place").cast("long").alias("number"), "first", "last", F.concat_ws("x", "copies", "sha256").alias("hash"))
        self.levels = [level]
        for _ in range(depth):
            level = materialize(_up(level, ["file_no"], "number"), "fixity-level")
            self.levels.append(level)
        level = level.select(F.lit(0).cast("long").alias("file_no"), F.col("file_no").alias("number"), "first", "last", "hash")
        while files > 1:
            level = materialize(_up(level, ["file_no"], "number"), "fixity-level")
            self.levels.append(level)
            files = -(-files // FANOUT)

    def root(self) -> str | None:
        found = self.levels[-1].select("hash").take(2)
        return found[0]["hash"] if len(found) == 1 else None


def depth_for(*leaf_tables: DataFrame) -> int:
    """Levels until the largest file has one root."""
    most = max(t.agg(F.coalesce(F.max("place"), F.lit(0))).first()[0] for t in leaf_tables)
    depth = 1
    while most >= FANOUT**depth:
        depth += 1
    return depth


def differing_blocks(a: Tree, b: Tree) -> DataFrame:
    """``file_no, number`` of the lowest blocks whose hashes differ, found by descending only where parents differ."""
    wrong = None
    for k in range(len(a.levels) - 1, 0, -1):
        sides = []
        for tree in (a, b):
            level = tree.levels[k]
            if wrong is not None:
                above_files = k == a.in_files  # the parents of file roots are numbered blocks of files
                parent_file = F.lit(0).cast("long") if above_files else F.col("file_no")
                parent = F.expr(f"{'file_no' if above_files else 'number'} div {FANOUT}")
                asked = wrong.select(F.col("file_no").alias("_file"), F.col("number").alias("_number"))
                level = level.withColumns({"_file": parent_file, "_number": parent}).join(asked, ["_file", "_number"], "left_semi")
            sides.append(level.select("file_no", "number", F.struct("first", "last", "hash").alias("node")))
        both = sides[0].withColumnRenamed("node", "left").join(sides[1].withColumnRenamed("node", "right"), ["file_no", "number"], "full")
        wrong = materialize(both.filter(~F.col("left").eqNullSafe(F.col("right"))).select("file_no", "number"), "fixity-wrong")
    return wrong


def audit(original: DataFrame, replica: DataFrame, file_records: int = FILE_RECORDS) -> DataFrame:
    """``page_id, file_no, first, last, copies, sha256, status`` of all records of both replicas.

    ``status``: ok, changed, missing (not in the replica) or extra (only there); extra records have the replica's
    offsets. ``copies`` is the count in the original, or in the replica where it is extra.
    """
    files = files_for(original, file_records)
    records = [materialize(leaves(p, files), "fixity-leaves") for p in (original, replica)]
    a, b = (Tree(r, files, depth_for(*records)) for r in records)
    blocks = differing_blocks(a, b)

    def inside(tree: Tree) -> DataFrame:
        rows = tree.leaves.withColumn("number", F.expr(f"cast(place as long) div {FANOUT}"))
        return rows.join(blocks, ["file_no", "number"], "left_semi")

    # a record of a differing block may stand in another differing block of the other replica
    key = ["page_id", "sha256", "copies"]
    left, right = inside(a).drop("number", "place"), inside(b).drop("number", "place")
    gone = left.join(right.select(*[F.col(c).alias(f"_{c}") for c in key]), _same(left, key), "left_anti")
    new = right.join(left.select(*[F.col(c).alias(f"_{c}") for c in key]), _same(right, key), "left_anti")
    new_ids = new.select(F.col("page_id").alias("_page_id")).distinct()
    gone_ids = gone.select(F.col("page_id").alias("_page_id")).distinct()
    changed = gone.join(new_ids, gone["page_id"].eqNullSafe(new_ids["_page_id"]), "left_semi").withColumn("status", F.lit("changed"))
    missing = gone.join(new_ids, gone["page_id"].eqNullSafe(new_ids["_page_id"]), "left_anti").withColumn("status", F.lit("missing"))
    extra = new.join(gone_ids, new["page_id"].eqNullSafe(gone_ids["_page_id"]), "left_anti").withColumn("status", F.lit("extra"))
    columns = ["page_id", "file_no", "first", "last", "copies", "sha256", "status"]
    damaged = materialize(reduce(DataFrame.union, [t.select(*columns) for t in (changed, missing, extra)]), "fixity-damaged")
    found = damaged.filter("status <> 'extra'").select(*[F.col(c).alias(f"_{c}") for c in key], "status")
    rows = a.leaves.join(found, _same(a.leaves, key), "left").withColumn("status", F.coalesce("status", F.lit("ok")))
    return rows.select(*columns).union(damaged.filter("status = 'extra'"))


def _same(df: DataFrame, key: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [df[c].eqNullSafe(F.col(f"_{c}")) for c in key])
