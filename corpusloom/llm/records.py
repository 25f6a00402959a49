"""Token ids in length-delimited binary records, with a separate index of offsets.

A file is a sequence of frames in ascending order of doc_id (nulls first, equal ids side by side):

    8 bytes   length of the payload, little-endian
    4 bytes   masked checksum of those 8 bytes
    n bytes   payload: 1 byte flags, 8 bytes doc_id, then the ids, 2 or 4 bytes each as the flags say
    4 bytes   masked checksum of the payload
    1 byte    line feed, the separator of the writer

A masked checksum is the crc32 rotated right by 15 bits plus 0xA282EAD8, so that checksums of data that hold
checksums stay independent. Files are written by Spark's own writer, so only finished tasks leave files, on any
file system. The index holds ``file_no, offset, length, doc_id, n_tokens`` of every frame; it is made from the files
alone, checks every sum on the way, and lets a reader fetch records in any order.

Null texts are empty: their record holds the end id only. Files hold at most ``FILE_RECORDS`` records.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import prefix_sums, scratch_path, texts_of
from corpusloom.llm.encoding import END_ID, encoder

FILE_RECORDS = 8192
# Less than the encoder's own: a worker holds them, of two ages, beside an executor that reads and writes texts.
KEPT_PIECES = 150_000
STEP_BYTES = 1_000_000
_HEAD, _ID = struct.Struct("<QI"), struct.Struct("<Bq")
_SUM = struct.Struct("<I")
WIDE, NO_ID = 1, 2


class DamagedFile(ValueError):
    """A frame whose checksum or length does not fit."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    head = _ID.pack((WIDE if wide else 0) | (NO_ID if doc_id is None else 0), doc_id or 0)
    payload = head + ids.astype("<u4" if wide else "<u2").tobytes()
    length = len(payload).to_bytes(8, "little")
    return length + _SUM.pack(masked(length)) + payload + _SUM.pack(masked(payload))


def parse(data: bytes | memoryview, offset: int = 0) -> tuple[int | None, np.ndarray, int]:
    """``doc_id``, ids and the offset behind the frame that starts at ``offset``."""
    view = memoryview(data)
    if offset + _HEAD.size > len(view):
        raise DamagedFile(f"the file ends inside the frame at {offset}")
    length, check = _HEAD.unpack_from(view, offset)
    if masked(view[offset : offset + 8]) != check or offset + _HEAD.size + length + _SUM.size > len(view):
        raise DamagedFile(f"the length at {offset} is damaged")
    payload = view[offset + _HEAD.size : offset + _HEAD.size + length]
    if masked(payload) != _SUM.unpack_from(view, offset + _HEAD.size + length)[0]:
        raise DamagedFile(f"the payload at {offset} is damaged")
    flags, doc_id = _ID.unpack_from(payload, 0)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=_ID.size)
    return (None if flags & NO_ID else doc_id), ids, offset + _HEAD.size + length + _SUM.size


def write_records(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, file_records: int = FILE_RECORDS) -> None:
    """Encode every text, append ``end_id`` and write the frames below ``path``, ordered by doc_id over all files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer, max_pieces=KEPT_PIECES, step_bytes=STEP_BYTES, two_ages=True), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = iter(batch.column("doc_id").to_pylist())
            for some in own.each(batch.column("text")):
                frames = [frame(i, np.frombuffer(e + end, "<u4")) for e, i in zip(some, ids)]
                yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])
        pa.default_memory_pool().release_unused()  # the worker outlives the task

    texts = texts_of(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    ordered = texts.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    frames = ordered.mapInArrow(run, "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", file_records).text(path)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, data in zip(batch.column("name"), batch.column("content")):
            view = memoryview(data.as_buffer())
            rows, offset, start = [], 0, 0
            while offset < len(view):
                doc_id, ids, after = parse(view, offset)
                rows.append((name.as_py(), offset, after - offset, doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
                offset = after + 1
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _INDEX_TYPES)], names=_INDEX_NAMES)


_INDEX_NAMES = ["name", "offset", "length", "doc_id", "start_in_file", "n_tokens", "ids_crc32"]
_INDEX_TYPES = [pa.string(), *[pa.int64()] * 6]
_INDEX = "name string, offset long, length long, doc_id long, start_in_file long, n_tokens long, ids_crc32 long"


def _files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Read the files back, check every frame and write where each starts; returns the index."""
    _files(spark, path).mapInArrow(_walk, _INDEX).write.parquet(index_path)
    return spark.read.schema(_INDEX).parquet(index_path)


def with_starts(index: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all records before, over all files in order."""
    part = F.regexp_extract("name", r"^part-(\d+)-", 1).cast("long")
    # the last group of the name: the write's uuid before it may hold a '-c<digit>' of its own
    piece = F.regexp_extract("name", r"-c(\d+)\.[^-]*$", 1).cast("long")
    files = index.groupBy("name").agg(F.sum("n_tokens").alias("ids")).select("name", "ids", F.struct(part.alias("part"), piece.alias("piece")).alias("place"))
    files = prefix_sums(files, "place", "ids", "before", F.expr("place.part div 256")).select("name", "before")
    return index.join(files, "name").withColumn("start", F.col("before") + F.col("start_in_file"))


def read_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """``doc_id, ids`` of the index rows in ``wanted`` (name, offset), in whatever order they are asked for.

    A task holds one file at a time and jumps to the offsets asked of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens = [], []
            for data, offsets in zip(batch.column("content"), batch.column("offsets").to_pylist()):
                for offset in offsets:
                    doc_id, found, _ = parse(data.as_buffer(), offset)
                    ids.append(doc_id)
                    tokens.append(found.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tokens, pa.list_(pa.int64()))], names=["doc_id", "ids"])

    asked = wanted.groupBy("name").agg(F.collect_list("offset").alias("offsets"))
    return _files(spark, path).join(asked, "name").select("content", "offsets").mapInArrow(run, "doc_id long, ids array<long>")


def records_round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all texts as records, then per document ``doc_id, start, n_tokens, ids_crc32`` from the files."""
    spark = docs.sparkSession
    path = scratch_path(spark, "records")
    write_records(docs, path, tokenizer)
    index = write_index(spark, path, scratch_path(spark, "records-index"))
    return with_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32", "name", "offset")
