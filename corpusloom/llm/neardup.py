"""Near-duplicate documents by SetSketch registers, banded, judged by likelihood, verified on whole sets.

A document's set holds its distinct shingles of five words (``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased); a
text of fewer words is one shingle; without words the set is empty and the document is linked with nothing.

1. ``sketches``: per document the size of its set, a 128-bit key of the set and 160 registers. Register i is the
   truncated logarithm, base ``BASE``, of the least of exponentially distributed values of all shingles, so equal
   registers are as frequent as shared shingles and registers of unions merge by their maximum.
2. Equal sets become one representative, its smallest doc_id, before anything is compared.
3. Representatives meet where the four registers of one of 40 bands agree: at similarity 0.75 a pair is missed
   by all bands with probability (1 - 0.75^4)^40 < 3e-7.
4. Two rounds of links. First every bucket's most connected member is compared with the others, a number of pairs
   no larger than the buckets. Then only members of a bucket that are still in different components are compared,
   and of those only pairs that share enough: what a document has in common with no other component is counted
   once and bounds its similarity to any. A pair already joined by other links needs no test, for the result is
   components.
5. A pair whose joint likelihood puts its similarity far below the limit is left; all others are verified on the
   full sets of words, exactly.
6. Components by repeated large-star and small-star steps on written tables.

A null doc_id takes part in no link; rows that share a doc_id count as one document; null and empty texts, extra
columns and an empty table give rows as any others.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize, texts_of

WIDTH = 5
LIMIT = (75, 100)
BANDS, ROWS = 40, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65_534
# A pair is verified unless its estimated similarity is this many standard errors below the limit.
ERRORS = 6.0
# Words whose hashes a worker keeps.
MAX_WORDS = 200_000

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_LOWER).split()


def shingles(text: str, width: int = WIDTH) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(width))))


class Sketcher:
    """Registers of texts; the hash functions are fixed numbers made by a rule, so all tasks agree."""

    def __init__(self):
        numbers = np.arange(1, 2 * REGISTERS + 1, dtype=np.uint64)
        mixed = _mix(numbers * np.uint64(0x9E3779B97F4A7C15))
        self.factors = (mixed[:REGISTERS] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        self.offsets = (mixed[REGISTERS:] >> np.uint64(32)).astype(np.uint32)
        self.words: dict[bytes, int] = {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        """Distinct 64-bit hashes of the shingles, sorted."""
        known = self.words
        for word in set(words):
            if word not in known:
                known[word] = xxhash.xxh64_intdigest(word)
        w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(known) > MAX_WORDS:
            known.clear()
        width = min(WIDTH, len(words))
        n = len(words) - width + 1
        h = np.full(n, width, np.uint64)
        for k in range(width):
            h = _mix(h + w[k : k + n])
        return np.unique(h)

    def registers(self, hashes: np.ndarray) -> np.ndarray:
        """Truncated logarithms of exponential minima, 0 to TOP + 1; larger is rarer, so unions merge by maximum."""
        least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for start in range(0, len(short), 256):
            part = short[start : start + 256, None] * self.factors
            part += self.offsets
            np.minimum(least, part.min(axis=0), out=least)
        value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
        return np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, TOP + 1).astype("<u2")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketcher = Sketcher()
    for batch in batches:
        sizes, keys, bands = [], [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            if not words:
                sizes.append(0)
                keys.append(None)
                bands.append(None)
                continue
            hashes = sketcher.hashes(words)
            sizes.append(len(hashes))
            keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
            bands.append(sketcher.registers(hashes).view("<i8"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "n_shingles", "set_key", "bands"],
        )
    pa.default_memory_pool().release_unused()  # the worker outlives the task


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key`` and the registers as 40 longs of four registers each, per document."""
    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_sketch, f"doc_id {kind}, n_shingles long, set_key binary, bands array<long>")


def similarity(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> float:
    """The most likely similarity of two sets of known size, from how often each one's registers are larger.

    With u and v the shares of the sizes, registers of a exceed those of b with probability p(u - v J) and the
    other way round with p(v - u J), where p(x) = -log_b(1 - x (b - 1) / b).
    """
    up, down = int((a > b).sum()), int((b > a).sum())
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    top = min(u / v, v / u)
    j = np.linspace(0.0, top, 513)

    def p(x):
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / math.log(BASE)

    wins, losses = p(u - v * j), p(v - u * j)
    ties = np.maximum(1 - wins - losses, 1e-12)
    score = up * np.log(np.maximum(wins, 1e-12)) + down * np.log(np.maximum(losses, 1e-12)) + (len(a) - up - down) * np.log(ties)
    return float(j[int(np.argmax(score))])


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    limit = LIMIT[0] / LIMIT[1]
    least = limit - ERRORS * math.sqrt(limit * (1 - limit) / REGISTERS)
    for batch in batches:
        sides = [np.array(batch.column(c).flatten()).view("<u2").reshape(-1, REGISTERS) for c in ("bands_a", "bands_b")]
        sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
        keep = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            small, large = sorted((int(sizes[0][k]), int(sizes[1][k])))
            if LIMIT[1] * small >= LIMIT[0] * large:  # sizes further apart can't be that similar
                keep[k] = similarity(sides[0][k], sides[1][k], int(sizes[0][k]), int(sizes[1][k])) >= least
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, known = None, set()
    for batch in batches:
        shared, missing, linked = [], [], []
        for a, b in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
            if a != last:
                last, known = a, shingles(a)
            other = shingles(b)
            both = len(known & other)
            shared.append(both)
            missing.append(_bits(known - other))
            linked.append(bool(known) and LIMIT[1] * both >= LIMIT[0] * (len(known) + len(other) - both))
        columns = [batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(missing, pa.int64()), pa.array(linked, pa.bool_())]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "shared", "missing", "linked"])


def _bits(some: set[tuple[bytes, ...]]) -> int:
    """64 bits, one set by each shingle: a bit that only one of two sets has proves a shingle that only it has."""
    bits = 0
    for shingle in some:
        bits |= 1 << (zlib.crc32(b" ".join(shingle)) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def _compared(pairs: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The likely ones of the pairs (a, b), written: how many shingles they ``shared``, bits of those of a that b is
    ``missing``, and whether they are ``linked``.
    """
    side = lambda s: reps.select(F.col("doc_id").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("bands").alias(f"bands_{s}"))
    judged = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_likely, "a long, b long")
    judged = materialize(judged, "neardup-judged")
    text = lambda s: texts.select(F.col("doc_id").alias(s), F.col("text").alias(f"text_{s}"))
    return materialize(judged.join(text("b"), "b").join(text("a"), "a").mapInArrow(_verify, "a long, b long, shared long, missing long, linked boolean"), "neardup-links")


def components(links: DataFrame) -> DataFrame:
    """``doc_id, component_id`` for every id in ``links`` (a, b): the smallest id reachable.

    Large-star and small-star steps until nothing changes; the number of rounds grows with the logarithm of the
    longest chain. Every step is a written table.
    """
    edges = materialize(links.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).filter("x < y").distinct(), "components")
    while True:
        before = _state(edges)
        both = edges.union(edges.select("y", "x"))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("m").alias("x"), "y").filter("x < y").distinct()
        least = large.groupBy("y").agg(F.min("x").alias("m"))
        small = large.join(least, "y").select(F.explode(F.array(F.struct(F.col("m").alias("x"), F.col("y")), F.struct(F.col("m").alias("x"), F.col("x").alias("y")))).alias("e"))
        edges = materialize(small.select("e.x", "e.y").filter("x < y").distinct(), "components")
        if _state(edges) == before:
            break
    own = edges.select(F.col("x").alias("doc_id"), F.col("x").alias("component_id")).distinct()
    return edges.select(F.col("y").alias("doc_id"), F.col("x").alias("component_id")).union(own)


def _state(edges: DataFrame) -> tuple:
    """A table of edges in three numbers: equal tables have equal ones."""
    h = F.xxhash64("x", "y")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 16)), F.bit_xor(h)).first())


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sketcher = Sketcher()
    for batch in batches:
        hashes = [sketcher.hashes(words_of(text)).view("<i8") for text in batch.column("text").to_pylist()]
        columns = [batch.column("doc_id"), batch.column("component"), pa.array(hashes, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "component", "hashes"])


def _shared_sizes(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``doc_id, n_shared``: how many shingles of a document occur in any document of another component.

    No set outside its component can share more with it. Hashes that collide make the number larger, never smaller.
    """
    held = texts.join(members, "doc_id").mapInArrow(_hashes, "doc_id long, component long, hashes array<long>")
    held = held.select("doc_id", "component", F.explode("hashes").alias("hash"))
    spread = held.groupBy("hash").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi")
    return held.join(spread.select("hash"), "hash").groupBy("doc_id").agg(F.count("*").alias("n_shared"))


def _mixed(met: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, with the component of the bucket's hub."""
    ends = met.groupBy("band", "value").agg(
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.min("n_shingles").alias("n_least"),
        F.max(F.when(F.col("doc_id") == F.col("hub"), F.col("component"))).alias("hub_component"),
    )
    return met.join(ends.filter("lo <> hi").drop("lo", "hi"), ["band", "value"])


def _across(met: DataFrame, compared: DataFrame, reps: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of bucket members in different components that could be as similar as the limit asks.

    With s shared shingles at most, two sets of n and m have a similarity of at most s / (n + m - s). What bounds s:

    - what a document shares with all other components together (``n_shared``);
    - inside the bucket's hub what each shares with the hub, as compared in the first round, less what only the
      other is missing there; plus outside of it what each shares with other components.

    Members that the first bound rules out with any other of their bucket leave at once. So a large group of edited
    copies, each close to a common original but not to one another, does not meet all against all. A pair comes
    out of the first of the bands it has in common.
    """
    met = materialize(_mixed(met), "neardup-mixed")
    shared = materialize(_shared_sizes(met.select("doc_id", "component").distinct(), texts), "neardup-shared")
    met = met.join(shared, "doc_id")
    enough = "{1} * {2} >= {0} * ({3} + {4} - {2})".format
    met = met.filter(enough(*LIMIT, "n_shared", "n_shingles", "greatest(n_shared, n_least)")).drop("n_least", "hub_component")
    met = _mixed(met).drop("n_least")
    known = compared.select(F.col("a").alias("hub"), F.col("b").alias("doc_id"), F.col("shared").alias("in_hub"), "missing")
    met = met.join(known, ["hub", "doc_id"], "left")
    in_hub = F.when(F.col("doc_id") == F.col("hub"), F.col("n_shingles")).otherwise(F.col("in_hub"))
    # a hub of another component shares only what counts as shared with other components
    other = F.coalesce(F.col("component") != F.col("hub_component"), F.lit(False))
    outside = F.when(other, F.col("n_shared") - in_hub).otherwise(F.least("n_shared", F.col("n_shingles") - in_hub))
    missing = F.when(F.col("doc_id") == F.col("hub"), F.lit(0)).otherwise(F.col("missing"))
    met = met.withColumns({"in_hub": in_hub, "outside": outside, "missing": missing}).join(reps.select("doc_id", "bands"), "doc_id")
    met = materialize(met.select("band", "value", "doc_id", "component", "n_shingles", "n_shared", "in_hub", "missing", "outside", "bands"), "neardup-mixed")
    side = lambda s: met.select("band", "value", *[F.col(c).alias(f"{c}_{s}") for c in met.columns[2:]])
    inside = "least(in_hub_a - bit_count(missing_b & ~missing_a), in_hub_b - bit_count(missing_a & ~missing_b))"
    most = f"least(n_shared_a, n_shared_b, {inside} + least(outside_a, outside_b))"
    bounded = "in_hub_a IS NULL OR in_hub_b IS NULL"
    most = f"CASE WHEN {bounded} THEN least(n_shared_a, n_shared_b) ELSE {most} END"
    can = enough(*LIMIT, most, "n_shingles_a", "n_shingles_b")
    first = "array_position(zip_with(bands_a, bands_b, (x, y) -> x = y), true) = band + 1"
    both = side("a").join(side("b"), ["band", "value"]).filter(f"component_a < component_b AND {can} AND {first}")
    return both.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row: ``component_id`` is the smallest linked id."""
    rows = materialize(sketches(docs), "neardup-sketches")
    some = rows.filter("doc_id IS NOT NULL AND set_key IS NOT NULL").withColumn("doc_id", F.col("doc_id").cast("long"))
    of_set = some.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    same = some.select("set_key", "doc_id").join(of_set, "set_key").filter("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    # a set's own row is found by its doc_id, which no large group of copies shares
    first = of_set.select(F.col("rep").alias("doc_id"), F.col("set_key").alias("own_key"))
    reps = some.join(first, "doc_id").filter("set_key = own_key").dropDuplicates(["doc_id", "set_key"])
    reps = materialize(reps.select("doc_id", "n_shingles", "bands"), "neardup-reps")

    met = reps.select("doc_id", "n_shingles", F.posexplode("bands").alias("band", "value"))
    counted = met.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialize(met.join(counted, ["band", "value"]), "neardup-bands")
    degree = met.groupBy("doc_id").agg(F.sum("n").alias("degree"))
    texts = texts_of(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = materialize(texts.join(degree.select("doc_id"), "doc_id", "left_semi"), "neardup-texts")

    ranked = met.join(degree, "doc_id")
    hub = ranked.groupBy("band", "value").agg(F.max(F.struct(F.col("degree"), -F.col("doc_id"))).alias("hub"))
    hub = hub.select("band", "value", (-F.col("hub.col2")).alias("a"))
    pairs = met.join(hub, ["band", "value"]).filter("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    pairs = materialize(pairs, "neardup-pairs")
    compared = _compared(pairs, reps, texts)
    links = compared.filter("linked").select("a", "b")

    label = materialize(components(links.union(same)), "neardup-labels")
    met = met.join(label, "doc_id", "left").withColumn("component", F.coalesce("component_id", "doc_id"))
    met = met.join(hub.withColumnRenamed("a", "hub"), ["band", "value"])
    rest = _across(met.select("band", "value", "doc_id", "n_shingles", "component", "hub"), compared, reps, texts)
    rest = rest.join(pairs_both(pairs), ["a", "b"], "left_anti")
    more = _compared(rest, reps, texts).filter("linked").select("a", "b")

    if more.take(1):
        label = materialize(components(links.union(same).union(more)), "neardup-labels")
    kind = rows.schema["doc_id"].dataType
    found = rows.select("doc_id", "n_shingles").join(label.withColumn("doc_id", F.col("doc_id").cast(kind)), "doc_id", "left")
    component = F.coalesce(F.col("component_id"), F.col("doc_id").cast("long"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id").cast("long") == component, F.lit(True)).alias("kept"))


def pairs_both(pairs: DataFrame) -> DataFrame:
    """Pairs in either order."""
    return pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def without_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every group of near-duplicates, that with the smallest doc_id; same columns.

    Rows that share a doc_id are one document; rows without one are kept.
    """
    found = near_duplicates(docs)
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    named = docs.filter(F.col("doc_id").isNotNull())
    named = named.join(gone, named["doc_id"] == gone["_gone"], "left_anti").dropDuplicates(["doc_id"])
    return named.union(docs.filter(F.col("doc_id").isNull()))
