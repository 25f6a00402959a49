"""Rules, records, packing, chat and encoding against brute force."""

import hashlib
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from llm.conftest import SF, TOKENIZER
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import chat, encoding, packing, queries, records, rules
from corpusloom.llm.common import scratch_path
from corpusloom.llm.encoding import Encoder

LIBRARY = Tokenizer.from_file(TOKENIZER)


def ids_of(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


# --- encoding ------------------------------------------------------------------------------------------


def test_chunked_encoding_equals_one_call():
    rng = random.Random(1)
    parts = ["a", "é", "'s", " ", "  ", "\n", "1", "!", "<|endoftext|>", "\t", "\xa0", "x", "don't", ".", "中", "\0", "\x1c", " "]
    own = Encoder(TOKENIZER)
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert own.encode(text) == ids_of(text)[:-1].tobytes(), text


def test_encoding_many_texts_in_small_steps(monkeypatch):
    rng = random.Random(11)
    parts = ["ab", "Été", "ß", "'ll", " ", " ", " ", "\n", "12", ",", ". ", "!\n", "<|endoftext|>", "\u2003", "\u2019", "\xa0", "word", "中", "\u3000", "×"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(20_000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    monkeypatch.setattr(encoding, "STEP_BYTES", 3000)
    monkeypatch.setattr(encoding, "MAX_PIECES", 500)  # forgets in between
    own = Encoder(TOKENIZER)
    assert own.encode_all(texts) == want
    assert own.counted(pa.array(texts).slice(3, 9000)).tolist() == [len(w) // 4 for w in want[3:9003]]
    assert own.encode_all([]) == [] and own.encode_all(["", ""]) == [b"", b""] and own.counted(pa.array([""])).tolist() == [0]


MEMORY_OF_A_BATCH = """
import random, resource, sys
import pyarrow as pa
from corpusloom.llm import encoding

rng = random.Random(3)
words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(250_000)]
texts = pa.array([" ".join(rng.choices(words, k=25_000)) for _ in range(100)])
own = encoding.encoder(sys.argv[1])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for some in own.each(texts):
    pass
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""


def test_memory_of_a_batch_is_bounded():
    out = subprocess.run([sys.executable, "-c", MEMORY_OF_A_BATCH, TOKENIZER], capture_output=True, text=True, check=True, cwd=Path(encoding.__file__).parents[2])
    assert int(out.stdout) < 180


def test_frequent_pieces_outlive_the_bound():
    rng = random.Random(13)
    own = Encoder(TOKENIZER, max_pieces=500, step_bytes=2_000, two_ages=True)
    encoded, joined = [], own._joined
    own._joined = lambda words, by: (encoded.extend(words), joined(words, by))[1]
    texts = ["every text " + " ".join(f"has{k}" for k in range(20)) + " " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(30)) for _ in range(200)]
    assert own.encode_all(texts) == [ids_of(t)[:-1].tobytes() for t in texts]
    assert encoded.count(b" text") == encoded.count(b" has7") == 1
    assert len(own.known) + len(own.older) < 2 * (500 + 2_000)
    own.forget()
    assert not own.known and not own.older


def test_known_pieces_are_looked_up_once():
    class Counted(dict):
        times = 0

        def _counted(name):
            def looked_up(self, *a):
                Counted.times += 1
                return getattr(dict, name)(self, *a)

            return looked_up

        get, __contains__, __getitem__ = map(_counted, ("get", "__contains__", "__getitem__"))

    own, texts = Encoder(TOKENIZER), [f"word{k} other{k % 7}" for k in range(50)]
    first = own.encode_all(texts)
    own.known = Counted(own.known)
    assert own.encode_all(texts) == first == [ids_of(t)[:-1].tobytes() for t in texts]
    assert Counted.times == 57  # 50 first words and 7 others


def test_long_pieces_are_not_kept():
    own = Encoder(TOKENIZER)
    texts = ["a\tb  " * 200 + str(k) for k in range(5)] + ["x" * 900, "y " + "z" * 900, "short text"]
    assert own.encode_all(texts) == own.encode_all(texts) == [ids_of(t)[:-1].tobytes() for t in texts]
    assert own.known and max(map(len, own.known)) <= encoding.MAX_KEPT_BYTES


# --- rules ---------------------------------------------------------------------------------------------


def slow_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {p for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), dup, len(repeated)


def test_measures_equal_brute_force(spark, docs_of, odd_rows):
    rng = random.Random(2)
    rows = odd_rows[:5] + odd_rows[6:]
    rows += [(k, "".join(rng.choice(["a", "b ", " ", "\n", "\x0b", "#", "$x", "é", "B!"]) for _ in range(rng.randint(0, 60)))) for k in range(10, 80)]
    got = rules.rule_ledger(docs_of(rows)).select("doc_id", *rules.MEASURES[:5]).collect()
    want = [(i, *slow_measures(t)) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_policies_and_ablations(spark, docs_of):
    good = " ".join(f"word{k}" for k in range(60))
    rows = [(1, good), (2, good + " #" * 30), (3, "few words"), (4, "few #####"), (5, None)]
    ledger = rules.rule_ledger(docs_of(rows))
    kept = {r["doc_id"]: r["ok"] for r in ledger.select("doc_id", rules.passes("prose-1").alias("ok")).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False}
    cost = {r["rule"]: tuple(r)[1:] for r in rules.ablations(ledger, "prose-1").collect()}
    assert cost["few_words"] == (3, 2, 1, 3)  # failed, by this rule alone, kept, kept without it
    assert cost["many_symbols"] == (2, 1, 1, 2)
    assert {r["kept"] for r in rules.ablations(ledger.filter("doc_id > 99"), "base-1").collect()} == {0}


# --- records -------------------------------------------------------------------------------------------


def test_records_round_trip(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    path = scratch_path(spark, "t-records")
    records.write_records(docs, path, TOKENIZER, file_records=3)
    index = records.write_index(spark, path, scratch_path(spark, "t-index"))
    got = sorted(map(tuple, records.with_starts(index).select("start", "doc_id", "n_tokens", "ids_crc32").collect()))
    expected = Counter((i, len(ids_of(t)), zlib.crc32(ids_of(t).tobytes())) for i, t in odd_rows)
    assert Counter(g[1:] for g in got) == expected
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    ids = [g[1] for g in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    wanted = index.filter("doc_id IN (4, -7)").select("name", "offset")
    read = {r["doc_id"]: r["ids"] for r in records.read_at(spark, path, wanted).collect()}
    assert read == {i: ids_of(t).tolist() for i, t in odd_rows if i in (4, -7)}


def test_starts_of_names_whose_uuid_looks_like_a_piece(spark):
    name = "part-{:05d}-5d0f3a52-8c1e-4b7a-c12d-0a1b2c3d4e5f-c{:03d}.txt{}"
    places = [(part, piece) for part in (0, 1) for piece in range(12)]
    rows = [(name.format(*p, ".gz" if p[0] else ""), 100 * k + r, 40 * r, k + 1) for k, p in enumerate(places) for r in (0, 1)]
    index = spark.createDataFrame(random.Random(5).sample(rows, len(rows)), "name string, doc_id long, offset long, n_tokens long")
    index = index.withColumn("start_in_file", F.when(F.col("offset") > 0, F.col("n_tokens")).otherwise(0))
    got = {r["doc_id"]: r["start"] for r in records.with_starts(index).collect()}
    at = 0
    for _, doc_id, _, n in rows:
        assert got[doc_id] == at
        at += n


def test_damage_is_found():
    data = bytearray(records.frame(9, np.array([1, 2, 70_000])))
    assert records.parse(data)[0] == 9 and records.parse(data)[1].tolist() == [1, 2, 70_000]
    for k in range(len(data)):
        hurt = bytearray(data)
        hurt[k] ^= 1
        with pytest.raises(records.DamagedFile):
            records.parse(hurt)
    with pytest.raises(records.DamagedFile):
        records.parse(data[:-1])


def test_empty_tables(spark, docs_of):
    none = docs_of([])
    assert records.records_round_trip(none, TOKENIZER).count() == 0
    assert packing.pack_documents(none, TOKENIZER).count() == 0
    assert rules.rule_ledger(none).count() == 0


# --- packing -------------------------------------------------------------------------------------------


def check_sequences(rows, docs, size):
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    expected = defaultdict(list)
    for doc_id, text in docs:
        ids = ids_of(text)
        at = piece = 0
        while at < len(ids):
            n = size if piece or len(ids) % size == 0 else len(ids) % size
            expected[doc_id].append((piece, at, n, zlib.crc32(ids[at : at + n].tobytes())))
            at, piece = at + n, piece + 1
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    return len(sequences)


def test_packing_leaves_small_workers(spark, docs_of, monkeypatch):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(40)) for _ in range(300)]
    own, most = Encoder(TOKENIZER, max_pieces=500, step_bytes=4_000), []
    ids = Encoder._ids
    monkeypatch.setattr(Encoder, "_ids", lambda self, *a: (ids(self, *a), most.append(len(self.known)))[0])
    assert own.encode_all(texts) == [ids_of(t)[:-1].tobytes() for t in texts]
    assert 500 < max(most) <= 500 + 4_000  # a step of bytes holds no more pieces than that
    own.forget()
    assert not own.known

    # the one worker of a single task has forgotten the task's pieces when the next one comes
    def held(batches):
        kept = encoding.encoder(TOKENIZER, max_pieces=packing.KEPT_PIECES, step_bytes=packing.STEP_BYTES)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(kept.known)] * len(batch))], names=["n"])

    for _ in range(8):  # as many times as there may be idle workers
        assert packing.token_pieces(docs_of(list(enumerate(texts))).coalesce(1), TOKENIZER).count() == len(texts)
    assert all(r["n"] == 0 for r in spark.range(64, numPartitions=8).mapInArrow(held, "n long").collect())


@pytest.mark.parametrize("group_rows", [4, 10_000])
def test_packing(spark, docs_of, odd_rows, group_rows):
    rng = random.Random(4)
    rows = odd_rows + [(k, "word " * rng.randint(0, 3000)) for k in range(100, 160)]
    got = packing.pack_documents(docs_of(rows), TOKENIZER, group_rows=group_rows).collect()
    n = check_sequences(got, rows, packing.SIZE)
    least = -(-sum(len(ids_of(t)) for _, t in rows) // packing.SIZE)
    assert n <= least + (1 if group_rows > 4 else 12)


def test_local_search_empties_bins():
    # best fit leaves three bins for 10 = 6 + 4 and 5 + 3 + 2, which an exchange brings into two
    lengths = [6, 5, 4, 3, 2]
    bins = packing.Bins(lengths, 10)
    bins.items, bins.room = [[0, 3], [1, 2], [4]], [1, 1, 8]
    bins.improve()
    left = [items for items in bins.items if items]
    assert len(left) == 2 and sorted(i for b in left for i in b) == list(range(5))
    assert all(sum(lengths[i] for i in b) <= 10 for b in left)


def test_no_bin_has_a_step_left():
    rng = random.Random(5)
    for _ in range(8):
        lengths = [rng.randint(1, rng.choice([300, 900, 1500])) for _ in range(600)]
        bins = packing.Bins(lengths)
        bins.best_fit()
        before = sum((bins.size - room) ** 2 for room in bins.room)
        bins.improve()
        assert sum((bins.size - room) ** 2 for room in bins.room) >= before
        assert sorted(i for items in bins.items for i in items) == list(range(600))
        assert not [k for k, room in enumerate(bins.room) if room and bins.items[k] and bins._step(k)]


def test_packing_is_close_to_the_bound():
    rng = random.Random(5)
    for draw in (lambda: rng.randint(1, 2047), lambda: min(2047, int(rng.expovariate(1 / 700)) + 1)):
        lengths = [draw() for _ in range(4000)]
        bins = packing.pack(lengths)
        assert sorted(i for b in bins for i in b) == list(range(4000))
        assert all(sum(lengths[i] for i in b) <= packing.SIZE for b in bins)
        assert len(bins) <= 1.01 * max(sum(lengths) / packing.SIZE, sum(n > packing.SIZE // 2 for n in lengths)) + 1


# --- chat ----------------------------------------------------------------------------------------------


def test_escaping_is_reversible():
    rng = random.Random(6)
    parts = [*chat.CONTROL, "\\", "[", "I", "\n", " ", "<", "|", "é", "中", "</", "s>", "\x00"]
    template = chat.Template(TOKENIZER)
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text
        assert not any(c in escaped for c in chat.CONTROL)
        turns = [("assistant", text), (text, "x")]
        ids = template.assemble(turns)
        assert template.parse(np.concatenate(ids)) == turns
        mask = template.loss_mask(np.concatenate(ids))
        learned = "".join(t for r, t in turns if r == "assistant")
        assert chat.unescape(template.text(np.concatenate(ids)[mask])) == learned


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "[INST] a\\b </s>"), (1, 2, None, None), (2, None, "assistant", ""), (None, 3, "assistant", "x"), (3, 1, "user", "y"), (3, 1, "user", "y")]
    talk = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = chat.read_back(chat.format_turns(talk, TOKENIZER), TOKENIZER).collect()
    by = defaultdict(list)
    for conv, _, role, text in rows:
        by[conv].append((role or "", text or ""))
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == {c: digests(t) for c, t in by.items()}
    assert chat.read_back(chat.format_turns(talk.limit(0), TOKENIZER), TOKENIZER).count() == 0


def test_query_six(spark):
    got = {r["conv_id"]: r for r in queries.op6_token_assembly(spark, SF).collect()}
    by = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by[r["conv_id"]].append((r["role"], r["text"]))
    by[-7] = [(role, "</s>[INST] ok [/INST]") for role in ("user", "assistant")]
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == {c: digests(t) for c, t in by.items()}


def test_queries_two_and_four(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    at, want = 0, []
    for doc_id, text in docs:
        ids = ids_of(text)
        want.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, queries.op2_framed_records(spark, SF).collect())) == want
    n = check_sequences(queries.op4_local_search(spark, SF).collect(), docs, 2048)
    assert n <= -(-at // 2048) + 1
