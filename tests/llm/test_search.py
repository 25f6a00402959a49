"""Token counts of huge texts, ranked search and source divergence against brute force."""

import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from llm.conftest import SF, TOKENIZER
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusloom.llm import divergence, lexical, queries, token_counts

LIBRARY = Tokenizer.from_file(TOKENIZER)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.SQL[name])
    order = [[c[0] for c in found.description].index(c) for c in got.columns]
    want = Counter(tuple(row[k] for k in order) for row in found.fetchall())
    assert want and Counter(map(tuple, got.collect())) == want


# --- token counts --------------------------------------------------------------------------------------

PARTS = ["word ", "don't ", "We'll", "été ", "  ", " ", "\n\n", "12", "!?", "<|endoftext|>", "中文", "\t", "\xa0", "'", "re", "a", "... "]


def long_rows(rng):
    rows = [(k, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 160)))) for k in range(100, 260)]
    # no word begins for longer than an overlap, at the begin, in the middle and at the end; and copies
    runs = ["x" * 900, "word " * 30 + "y" * 700 + " z" * 40, "one two " * 40 + "!" * 500, " " * 800, "<|endoftext|>" * 60, "a" * 300 + " " + "b" * 300]
    return rows + [(300 + k, t) for k, t in enumerate(runs * 2)]


@pytest.mark.parametrize("chunk, overlap", [(40, 16), (64, 30), (200, 40)])
def test_token_counts_of_chunks_equal_one_call(spark, docs_of, odd_rows, chunk, overlap):
    rows = odd_rows + long_rows(random.Random(chunk))
    got = token_counts.token_counts(docs_of(rows), TOKENIZER, chunk, overlap).collect()
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_huge_text_is_encoded_in_chunks(spark, docs_of, odd_rows):
    long_text = odd_rows[5][1]
    assert len(long_text) > 3 * token_counts.CHUNK
    got = token_counts.token_counts(docs_of([(1, long_text), (2, long_text), (3, "short")]), TOKENIZER).collect()
    n = len(LIBRARY.encode(long_text, add_special_tokens=False).ids)
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == [(1, n), (2, n), (3, len(LIBRARY.encode("short").ids))]


def test_other_vocabularies_are_counted_whole(spark, docs_of):
    from sentencepiece import SentencePieceProcessor

    rows = [(1, "Some words, and  more"), (2, None), (3, "été 中文 " * 30)]
    for name in ("word_bpe_49k.json", "piece_bpe_32k.model"):
        path = public_tokenizers.path(name)
        assert token_counts.look_ahead(path) is None
        got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs_of(rows), path, 20, 8).collect()}
        if name.endswith(".model"):
            pieces = SentencePieceProcessor(model_file=path)
            assert got == {i: len(pieces.encode(t or "")) for i, t in rows}
        else:
            whole = Tokenizer.from_file(path)
            assert got == {i: len(whole.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    assert token_counts.look_ahead(TOKENIZER) == len("<|endoftext|>")


def test_token_counts_of_nothing(spark, docs_of):
    assert token_counts.token_counts(docs_of([]), TOKENIZER).count() == 0


# --- ranked search -------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def slow_ranks(docs, items, top):
    terms = [(i, Counter(TERM.findall(lowered(t)))) for i, t in docs]
    terms = [(i, c, sum(c.values())) for i, c in terms if c]
    n_docs, n_terms = len(terms), sum(n for _, _, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c, n in terms:
            score = 0
            for t, times in Counter(TERM.findall(lowered(text))).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * (75 + 25 * n * n_docs // n_terms)))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        out += [(item_id, k + 1, i, -s) for k, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:top])]
    return out


def search_tables(rng):
    words = [f"w{k}" for k in range(120)] + ["É", "中文", "A1"]
    text = lambda n: " ".join(rng.choice(words) if rng.random() < 0.7 else rng.choice(words[:5]) for _ in range(n))
    docs = [(k, text(rng.randint(1, 60))) for k in range(700)]
    docs += [(k, docs[3][1]) for k in (900, 901, 902, 3, None)] + [(903, ""), (904, None), (905, "?!"), (906, "W1 w1 W1")]
    items = [(k, text(rng.randint(1, 12))) for k in range(90)] + [(200, None), (201, "..."), (3, docs[3][1]), (None, "w1 w1 w7"), (202, "nowhere")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("max_cells, top", [(lexical.MAX_CELLS, 20), (900, 3)])
def test_ranks_equal_brute_force(spark, docs_of, monkeypatch, max_cells, top):
    monkeypatch.setattr(lexical, "MERGE_PARTS", 3)
    docs, items = search_tables(random.Random(top))
    item_table = spark.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, score int")
    got = lexical.ranked(docs_of(docs).repartition(3), item_table, top, max_cells)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(slow_ranks(docs, items, top), key=repr)


@pytest.mark.parametrize("long_item", [False, True])
def test_node_pairs_prune_and_lose_nothing(long_item):
    import numpy as np

    rng = random.Random(4)
    vocabulary = [b"t%d" % k for k in range(300)]
    topics = [rng.sample(vocabulary, 12) for _ in range(40)]
    counts = [Counter(rng.sample(topics[k % 40], 6)) for k in range(80)]
    if long_item:
        counts[0] = Counter({vocabulary[0]: 10**9})  # sums beyond 2^53
    weights = np.array([rng.randint(1000, 9000) for _ in vocabulary], np.int64)
    tree = lexical.Items(counts, vocabulary, weights)
    assert tree.levels[0].dtype == (np.int64 if long_item else np.float64)
    search, ids, rows = lexical.Search(tree, weights, 3), [], []
    for k in range(3000):
        ids.append(k)
        rows.append({vocabulary.index(t): rng.randint(1, 900_000) for t in rng.sample(topics[rng.randrange(40)], rng.randint(0, 8))})
    for start in range(0, 3000, 1000):
        some = rows[start : start + 1000]
        ends = np.cumsum([0, *map(len, some)])
        flat = [(t, v) for row in some for t, v in sorted(row.items())]
        search.shard(ids[start : start + 1000], lexical.Rows(np.array([t for t, _ in flat]), np.array([v for _, v in flat]), ends))
    want = []
    for item, c in enumerate(counts):
        scores = [(-sum(v * int(weights[t]) * c[vocabulary[t]] for t, v in row.items()), k) for k, row in enumerate(rows)]
        want += [(item, k, -s) for s, k in sorted(scores)[:3] if s]
    assert sorted(search.rows()) == sorted(want)
    assert search.pairs < 3000 * len(counts) / 5


def test_ranks_equal_sql(spark):
    same_as_sql(spark, "op12_dual_tree")


def test_ranks_of_nothing(spark, docs_of):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.ranked(docs_of([]), items).count() == 0
    assert lexical.ranked(docs_of([(1, "a b")]), items.filter("false")).count() == 0


# --- source divergence ---------------------------------------------------------------------------------


def slow_divergence(rows, ranks):
    word = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    df, counts = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for _, text, lang, source in rows:
        c = Counter(word.findall(lowered(text)))
        df[lang or ""].update(c.keys())
        counts[lang or ""][source or ""].update(c)
    out = []
    for lang, sources in counts.items():
        kept = [t for t, n in df[lang].items() if n >= 3]
        size = len(kept)

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + size) for t in kept}

        q = shares(sum(sources.values(), Counter()))
        for source, c in sources.items():
            p = shares(c)
            pairs = [(-sum((p[t] - r[t]) ** 2 // r[t] for t in kept), other) for other, r in ((o, shares(x)) for o, x in sources.items() if o != source)]
            terms = [(-((p[t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if c[t] and p[t] > q[t]]
            out += [(lang, source, "pair", other, -v, k + 1) for k, (v, other) in enumerate(sorted(pairs))]
            out += [(lang, source, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(sorted(terms)[:ranks])]
    return out


def divergence_rows(rng):
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyzÉé"] + ["中", "Ab", "rare" + "q"]
    rows = []
    for k in range(300):
        lang, source = rng.choice([("en", "s1"), ("en", "s2"), ("en", "s3"), ("de", "s1"), ("de", "t"), (None, "u"), (None, None), ("x\0y", "v"), ("x", "y\0v")])
        rows.append((k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) + rng.choice(["", " 7", "!", " once" + "abcdefghij"[k % 10] * (k // 10 + 1)]), lang, source))
    rows += [(400, None, "en", "empty"), (401, "", "fr", "only"), (402, None, "fr", "other"), (7, rows[7][1], rows[7][2], rows[7][3]), (None, "ax ay", "en", "s1")]
    return rows


@pytest.mark.parametrize("block_terms, block_counts, ranks", [(500_000, 200_000, 200), (250, 30, 5)])
def test_divergence_equals_brute_force(spark, docs_of, block_terms, block_counts, ranks):
    rows = divergence_rows(random.Random(ranks))
    schema = docs_of([]).schema
    table = spark.createDataFrame([(i, t, lang, source, 0, 1, "v", 2) for i, t, lang, source in rows], schema)
    got = divergence.divergence(table.repartition(3), 3, ranks, block_terms, block_counts)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == sorted(slow_divergence(rows, ranks))


def test_divergence_reads_texts_once(spark, docs_of):
    rows = divergence_rows(random.Random(6))
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    table = spark.createDataFrame([(i, t, lang, source, 0, 1, "v", 2) for i, t, lang, source in rows], docs_of([]).schema)
    sums, _ = divergence.group_sums(table.mapInArrow(counted, table.schema), 3, 250)
    assert sums.count() and read.value == len(rows)


def test_divergence_in_small_rows_and_steps(spark, docs_of, monkeypatch):
    rows = divergence_rows(random.Random(8))
    table = spark.createDataFrame([(i, t, lang, source, 0, 1, "v", 2) for i, t, lang, source in rows], docs_of([]).schema)
    named = table.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    batch = pa.RecordBatch.from_pylist([r.asDict() | {"text": r["text"].encode()} for r in named.collect()])
    monkeypatch.setattr(divergence, "ROW_TERMS", 7)
    monkeypatch.setattr(divergence, "STEP_BYTES", 300)
    numbers, groups, cells, counts = defaultdict(divergence.Numbers), {}, [], []
    got, df = Counter(), Counter()
    for part, lists in divergence._slices(iter([batch])):
        langs = part.column("lang").to_pylist()
        doc, index, n = divergence.vectors_of(lists, [numbers[lang] for lang in langs])
        group = np.array([groups.setdefault(pair, len(groups)) for pair in zip(langs, part.column("source").to_pylist())])
        cells.append(index << 32 | group[doc])
        counts.append(n)
    for row in divergence._held_batch(numbers, groups, cells, counts, 3).to_pylist():
        assert len(row["terms"]) <= 7 and len(row["held"]) == 3
        got.update({(row["lang"], row["sources"][s], row["terms"][t]): n for s, t, n in zip(row["source"], row["term"], row["n"])})
        df.update(term for k in row["held"] for term in row["terms"][:k])
    want, want_df = Counter(), Counter()
    for r in batch.to_pylist():
        words = [r["lang"] + "\0" + w for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(r["text"].decode()))]
        want.update((r["lang"], r["source"], w) for w in words)
        want_df.update(set(words))
    assert got == want and df == {term: min(n, 3) for term, n in want_df.items()}


def test_reading_texts_holds_one_language_more(monkeypatch):
    rng = random.Random(9)
    rows = [{"lang": "abcd"[k % 4], "source": f"s{k % 3}", "text": " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(1000)).encode()} for k in range(400)]
    monkeypatch.setattr(divergence, "named", lambda docs: docs)
    run = divergence.held_terms(SimpleNamespace(mapInArrow=lambda run, schema: run), 3)
    batch, got = pa.RecordBatch.from_pylist(rows), Counter()
    tracemalloc.start()
    try:
        for row in run(iter([batch])):
            (lang,), n = row["lang"].to_pylist(), pc.sum(row["n"].flatten()).as_py()
            got[lang] += n
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == dict.fromkeys("abcd", 100_000)
    assert most < 60_000_000  # 78 MB with all languages made into rows at once, 43 with one


def test_vectors_equal_those_of_the_model(spark, docs_of):
    rows = [(k, t) for k, (_, t, _, _) in enumerate(divergence_rows(random.Random(3)))]
    lists = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(t)) for _, t in rows]
    model = divergence.CountVectorizer(inputCol="terms", outputCol="vector", minDF=3.0).fit(spark.createDataFrame([(w,) for w in lists], "terms array<string>"))
    want = [r[0] for r in model.transform(spark.createDataFrame(list(enumerate(lists)), "k long, terms array<string>")).orderBy("k").select("vector").collect()]
    index = {term.encode(): k for k, term in enumerate(model.vocabulary)}
    doc, at, n = divergence.vectors_of([[w.encode() for w in words] for words in lists], [index] * len(lists))
    for k, vector in enumerate(want):
        assert at[doc == k].tolist() == vector.indices.tolist() and n[doc == k].tolist() == vector.values.tolist()


def test_divergence_sums_are_rows_of_many_counts(spark, docs_of):
    rows = divergence_rows(random.Random(5))
    table = spark.createDataFrame([(i, t, lang, source, 0, 1, "v", 2) for i, t, lang, source in rows], docs_of([]).schema)
    want = defaultdict(Counter)
    for _, text, lang, source in rows:
        want[lang or ""].update((source or "", w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text)))
    for block_counts, most in ((200_000, 1), (100, 20)):
        sums, vocabulary = divergence.group_sums(table.repartition(3), 1, 500_000, block_counts)
        terms = {r["index"]: r["term"] for r in vocabulary.collect()}
        got, seen, per_lang = defaultdict(Counter), Counter(), Counter()
        for r in sums.collect():
            per_lang[r["lang"]] += 1
            seen.update({(r["lang"], k) for k in r["index"]})
            assert r["v"] == len(set(r["index"])) and r["index"] == sorted(r["index"])
            assert r["totals"] == [sum(n for s, n in zip(r["source"], r["n"]) if s == k) for k in range(len(r["sources"]))]
            got[r["lang"]].update({(r["sources"][s], terms[k]): n for s, k, n in zip(r["source"], r["index"], r["n"])})
        assert max(per_lang.values()) <= most and set(seen.values()) == {1}
        assert got == {lang: c for lang, c in want.items() if c}


def test_divergence_terms_keep_ties_at_the_last_rank():
    group, term = np.array([0, 1, 0, 1, 0, 0]), np.array([0, 0, 1, 2, 3, 4])
    n = np.array([9, 1, 4, 9, 4, 1])
    entry, value = divergence._term_values(group, term, n, np.array([23, 15]), 33, 2)
    assert sorted(term[entry[group[entry] == 0]].tolist()) in ([0, 1, 3], [1, 3]) and len(value) == len(entry)
    with pytest.raises(OverflowError):
        divergence._term_values(group, term, n * 10**9 * 2, np.array([23, 15]), 33, 2)


def test_divergence_of_nothing(spark, docs_of):
    assert divergence.divergence(docs_of([])).count() == 0


def test_divergence_equals_sql(spark):
    same_as_sql(spark, "op13_source_divergence")
