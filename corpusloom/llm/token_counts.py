"""Token counts of whole texts; a huge text is encoded in overlapping chunks that are spliced where both agree.

Texts of at most ``chunk`` characters are counted where they are read. A longer one is cut into chunks of that length,
each of which shares ``overlap`` characters with the next, and the chunks are encoded by whatever tasks are free.
What a chunk tells is small: its number of tokens, and where in its two overlaps a word of the tokenizer's pattern
begins and how many of its tokens lie before.

**Why a splice is right.** The pattern is matched from left to right without looking back, so what follows the
begin of a word depends on the text from there on only. A chunk that begins at a true begin of a word is right up to
its last few characters: the pattern looks at most two characters ahead, an added token at most its own length. So a
begin of a word that the earlier chunk reports far enough from its end is true, and where the later chunk
has a begin at the same place, it is right from there on. By induction every count between two splices is that of one call.

**When nothing agrees** (a run of letters longer than the overlap), the text is cut again with chunks and overlaps
``WIDEN`` times as long, in the end as one piece.

Chunks are named by the digest of their text, so copies of a text are encoded once and nothing depends on ids. Null texts
are empty and have 0 tokens; rows that share an id, null ids and repeated rows are rows of their own; an empty table gives
none; other columns, whatever their names, are left out.

The method holds for byte-level vocabularies with the library's own pattern. Texts of other vocabularies (``.model`` files,
normalizers, added tokens that take white space) are encoded whole, each by one call.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm.common import by_batch, materialize, texts_of
from corpusloom.llm.encoding import encoder

CHUNK = 32_768
OVERLAP = 512
# Chunks and overlaps grow by this factor where no common begin of a word was found.
WIDEN = 8
LOOK_AHEAD = 2
# Characters of chunk texts that are encoded at once.
STEP_CHARS = 1_000_000


def look_ahead(path: str) -> int | None:
    """How many characters decide whether a word begins at a place; None where chunks can't be spliced."""
    if not path.endswith(".json"):
        return None
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pattern, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
    if pattern.get("type") != "ByteLevel" or pattern.get("add_prefix_space") or not pattern.get("use_regex", True):
        return None
    if spec["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
        return None
    return max([LOOK_AHEAD, *(len(t["content"]) for t in added)])


@functools.cache
def counter(path: str) -> Callable[[pa.Array], np.ndarray]:
    """The function of a worker that counts the tokens of every text of an Arrow array."""
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        pieces = SentencePieceProcessor(model_file=path)
        return lambda texts: np.array([len(ids) for ids in pieces.encode(texts.to_pylist(), num_threads=1)], np.int64)
    if look_ahead(path) is not None:
        return encoder(path).counted
    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    return lambda texts: np.array([len(e) for e in whole.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)], np.int64)


def words_begin(path: str, texts: list[str]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For every text its number of tokens, where words of the pattern begin, and the tokens before each."""
    out = []
    for encoded in encoder(path).tokenizer.encode_batch(texts, add_special_tokens=False):
        words = np.array(encoded.word_ids, np.int64)
        before = np.flatnonzero(np.diff(words, prepend=-1))
        places = np.fromiter((a for a, _ in encoded.offsets), np.int64, len(words))
        out.append((len(words), places[before], before))
    return out


_CHUNKS = "key string, chunk_no long, start long, last boolean, text string"
_FOUND = "key string, chunk_no long, last boolean, n_tokens long, tail_at array<long>, tail_before array<long>, head_at array<long>, head_before array<long>"


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                starts = range(0, max(1, len(text) - overlap), chunk - overlap)
                for some in range(0, len(starts), 64):
                    rows = [(key, k, starts[k], k == len(starts) - 1, text[starts[k] : starts[k] + chunk]) for k in range(some, min(some + 64, len(starts)))]
                    types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", "chunk_no", "start", "last", "text"])

    return run


def _encoded(path: str, chunk: int, overlap: int, margin: int):
    def make():
        def step(batch: pa.RecordBatch) -> dict:
            names = ("n_tokens", "tail_at", "tail_before", "head_at", "head_before")
            columns: dict[str, list] = {name: [] for name in names}
            texts, starts = batch.column("text").to_pylist(), batch.column("start").to_pylist()
            some = max(1, STEP_CHARS // chunk)
            for k in range(0, len(texts), some):
                for text, start, (n, at, before) in zip(texts[k : k + some], starts[k : k + some], words_begin(path, texts[k : k + some])):
                    head = at <= overlap
                    tail = (at >= chunk - overlap) & (at <= len(text) - margin)
                    for name, value in zip(names, (n, at[tail] + start, before[tail], at[head] + start, before[head])):
                        columns[name].append(value)
            return columns | {name: batch.column(name) for name in ("key", "chunk_no", "last")}

        return step

    return make


def spliced(found: DataFrame) -> DataFrame:
    """``key, aligned, n_tokens`` of every text from what its chunks tell."""
    by_chunk = Window.partitionBy("key").orderBy("chunk_no")
    at = F.array_min(F.array_intersect("tail_at", F.lead("head_at").over(by_chunk)))
    nearby = found.withColumns({"at": at, "next_at": F.lead("head_at").over(by_chunk), "next_before": F.lead("head_before").over(by_chunk)})

    def tokens_before(places: str, counts: str):
        return F.element_at(counts, F.array_position(places, F.col("at")).cast("int"))

    span = tokens_before("tail_at", "tail_before") - tokens_before("next_at", "next_before")
    own = F.when(F.col("last"), F.col("n_tokens")).when(F.col("at").isNotNull(), span)
    return nearby.groupBy("key").agg(F.bool_and(F.col("last") | F.col("at").isNotNull()).alias("aligned"), F.sum(own).alias("n_tokens"))


def spliced_counts(texts: DataFrame, tokenizer: str, margin: int, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``key, n_tokens`` of texts (``key, text``); equal keys have equal texts."""
    done = None
    while True:
        overlap = min(overlap, chunk // 2)
        chunks = texts.mapInArrow(_cut(chunk, overlap), _CHUNKS).dropDuplicates(["key", "chunk_no"])
        found = materialize(by_batch(chunks, _encoded(tokenizer, chunk, overlap, margin), _FOUND), "token-chunks")
        counts = spliced(found)
        aligned = counts.filter("aligned").select("key", "n_tokens")
        done = aligned if done is None else done.union(aligned)
        failed = materialize(counts.filter("NOT aligned").select("key"), "token-chunks-failed")
        if failed.isEmpty():
            return done
        texts = texts.join(failed, "key", "left_semi")
        chunk, overlap = chunk * WIDEN, overlap * WIDEN


def token_counts(docs: DataFrame, tokenizer: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every text, as one call of the library per text would give them."""
    texts = texts_of(docs).select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    margin = look_ahead(tokenizer)
    short = texts if margin is None else texts.filter(F.char_length("text") <= chunk)

    def make():
        count = counter(tokenizer)

        def step(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"), "n_tokens": pa.array(count(batch.column("text")))}

        return step

    counted = by_batch(short, make, f"doc_id {id_type}, n_bytes long, n_tokens long")
    if margin is None:
        return counted
    long = texts.filter(F.char_length("text") > chunk).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    counts = spliced_counts(long.select("key", "text"), tokenizer, margin, chunk, overlap)
    return counted.union(long.select("doc_id", "n_bytes", "key").join(counts, "key").select("doc_id", "n_bytes", "n_tokens"))
