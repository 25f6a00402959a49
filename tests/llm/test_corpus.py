"""Near-duplicates, contamination, toxicity, secrets, rings, archives and the pipeline against brute force."""

import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from llm.conftest import SF
from pyspark.sql import functions as F

from corpusloom.llm import contamination, fixity, neardup, queries, ring, secrets_scan, toxicity

# --- near-duplicates -----------------------------------------------------------------------------------


def slow_components(rows):
    """Smallest id reachable over pairs of at least 75 % common shingles, all pairs compared."""
    sets, parent = {}, {}
    for doc_id, text in rows:
        if doc_id is not None:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
            words = re.findall(r"[^\x20\x09-\x0D]+", low)
            grams = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
            sets[doc_id], parent[doc_id] = grams, doc_id

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited(rng, words, share):
    return [rng.choice("abcdefgh") + str(rng.randint(0, 99)) if rng.random() < share else w for w in words]


def near_rows(rng):
    """Groups of copies edited more or less, chains of copies, and short texts."""
    rows, at = [], 100
    for _ in range(5):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(30, 150))]
        for _ in range(25):
            rows.append((at, " ".join(edited(rng, base, rng.choice([0, 0.01, 0.02, 0.04, 0.08])))))
            at += 1
        for _ in range(8):  # each a copy of the last
            base = edited(rng, base, 0.015)
            rows.append((at, " ".join(base)))
            at += 1
    rows += [(at + k, t) for k, t in enumerate(["A b c", "a B c", "a b c d", "x", "X", "x x x x x x x", "x x x x x"])]
    rng.shuffle(rows)
    return rows


def test_near_duplicates_equal_all_pairs(spark, docs_of, odd_rows):
    rows = odd_rows + near_rows(random.Random(7))
    got = neardup.near_duplicates(docs_of(rows)).collect()
    want = slow_components(rows)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_near_duplicates_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op5_setsketch(spark, SF).collect()}
    assert got == slow_components(rows)


def test_registers_merge_and_estimate():
    sketcher, rng = neardup.Sketcher(), random.Random(8)
    for share in (0.3, 0.6, 0.75, 0.9):
        n = 3000
        a = np.array([rng.getrandbits(64) for _ in range(n)], np.uint64)
        fresh = int(n * (1 - share) / (1 + share))
        b = np.concatenate([a[: n - fresh], np.array([rng.getrandbits(64) for _ in range(fresh)], np.uint64)])
        ra, rb = sketcher.registers(a), sketcher.registers(b)
        assert (np.maximum(ra, rb) == sketcher.registers(np.union1d(a, b))).all()
        true = (n - fresh) / (n + fresh)
        assert abs(neardup.similarity(ra, rb, n, n) - true) < 5 * (true * (1 - true) / neardup.REGISTERS) ** 0.5


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(7, 7), (300, 200)]
    got = {r[0]: r[1] for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {200: 200, 300: 200}
    assert got == want


# --- contamination -------------------------------------------------------------------------------------


def slow_hits(texts, items, width):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return word.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if item is not None and w:
            for k in range(max(1, len(w) - width + 1)):
                windows[tuple(w[k : k + width])].add(str(item))
    lengths, out = {len(w) for w in windows}, []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("shard", [3, 40, 10**6])
def test_index_equals_brute_force(monkeypatch, shard):
    monkeypatch.setattr(contamination, "SHARD_WORDS", shard)
    rng = random.Random(shard)
    for _ in range(60):
        some = ["a", "b", "é", "C", "1"][: rng.randint(1, 5)]

        def text(n, some=some):
            return " ".join(rng.choice(some) for _ in range(n))

        items = [(str(i), text(rng.choice([0, 1, 2, 5, 9]))) for i in range(rng.randint(0, 5))]
        texts = [text(rng.choice([0, 1, 3, 30, 80])) + rng.choice(["", " zz "]) + text(rng.choice([0, 1, 9])) for _ in range(6)]
        counts, spans, found = contamination._found(texts, contamination.Phrases(items, 4))
        got = [(n, sum(b - a for a, b in s), f) for n, s, f in zip(counts, spans, found)]
        assert got == slow_hits(texts, items, 4)


def test_contamination_of_odd_rows_and_blocks(spark, docs_of, odd_rows):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(12)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([0, 3, 6])))) for k in range(9)] + [(None, "w1 w2"), (5, None)]
    rows = odd_rows + [(k, " ".join(rng.choice(words) for _ in range(60))) for k in range(20, 40)]
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, n_words string")
    want = Counter((i, n, h, tuple(f)) for (i, _), (n, h, f) in zip(rows, slow_hits([t for _, t in rows], items, 3)))
    for limit in (10**6, 7):
        found = contamination.contamination(docs_of(rows), bench, 3, limit)
        got = Counter((r[0], r[1], r[2], tuple(r[3])) for r in found.select("doc_id", "n_words", contamination.hit_words(), "items").collect())
        assert got == want
    none = contamination.contamination(docs_of(rows), bench.limit(0))
    assert none.filter(F.size("spans") > 0).count() == 0 and none.count() == len(rows)


def test_query_seven(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {}
    for (doc_id, _), (n, hit, found) in zip(docs, slow_hits([t for _, t in docs], items, 13)):
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        want[doc_id] = (n, hit, len(found), digest, hit > 0 and 20 * hit >= n)
    got = queries.op7_fm_index(spark, SF).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == want
    assert any(r["contaminated"] for r in got)


# --- toxicity ------------------------------------------------------------------------------------------


def held_out_quality(spark, sf_dir):
    found = queries.op3_clause_grammar(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    return Counter((r["toxic"], r["predicted"]) for r in found.filter("held_out").select("toxic", "predicted").collect())


def test_held_out_accuracy(spark):
    n = held_out_quality(spark, "/root/testdata/sf0.1")
    assert n[1, 1] >= 0.85 * (n[1, 0] + n[1, 1]) and n[0, 1] <= 0.01 * (n[0, 0] + n[0, 1])


def test_scores_of_odd_rows(spark, docs_of, odd_rows):
    rows = odd_rows + [(k, "you are an idiot" if k % 2 else "a fine day") for k in range(20, 60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(20, 60)] + [(None, 1), (3, None), (999, 1)], "doc_id long, toxic int")
    docs = docs_of(rows)
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 5 == 0) for r in got)
    predicted = {r["doc_id"]: r["predicted"] for r in got}
    assert all(predicted[k] == k % 2 for k in range(20, 60)) and predicted[2] == 0
    kept = toxicity.without_toxic(docs, model)
    assert kept.schema == docs.schema and kept.count() == len(rows) - 20
    nothing = toxicity.train(docs, labels.limit(0))
    assert toxicity.score(docs.limit(0), nothing).count() == 0


def test_labels_of_held_out_rows_are_not_seen(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    used = [r["doc_id"] for r in toxicity.training_rows(docs, labels).select("doc_id").collect()]
    assert used and not [i for i in used if zlib.crc32(str(i).encode()) % 5 == 0]
    assert toxicity.training_rows(docs, labels, 10).count() == 10


def test_the_lexicon_keeps_every_count(spark, docs_of):
    def spelled(k):
        return "".join(chr(97 + k // 26**i % 26) for i in (3, 2, 1, 0))

    insults = [spelled(k) for k in range(11_000)]  # 22,000 toxic words and beginnings
    mild = [f"qwerbad{spelled(k)}" for k in range(21_000)]  # rare harmless words below a toxic beginning
    texts = [("qwerbad", 1)] * 60 + [(" ".join(insults), 1)] * 6 + [(" ".join(mild), 0)] * 6 + [("fine", 0)] * 700
    ids = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 5][: len(texts)]
    labels = spark.createDataFrame([(i, y) for i, (_, y) in zip(ids, texts)], "doc_id long, toxic int")
    lexicon = toxicity.train(docs_of([(i, t) for i, (t, _) in zip(ids, texts)]), labels).lexicon
    want, n_toxic = defaultdict(lambda: [0, 0]), 66
    for text, label in texts:
        for node in {x for w in text.split() for x in toxicity.nodes_of(w)}:
            want[node] = [want[node][0] + label, want[node][1] + 1]
    stems = {x[:4] for x, (t, n) in want.items() if t >= 5 and t * len(texts) > 2 * n * n_toxic}
    assert lexicon.counts == {x: tuple(c) for x, c in want.items() if c[1] >= 5 and x[:4] in stems}
    assert {lexicon.classify(w)[0] for w in mild} == {toxicity.OTHER}
    assert {lexicon.classify(w)[0] for w in ("qwerbad", *insults)} == {toxicity.INSULT}


def test_clause_events():
    t = toxicity
    assert t.clause_events([t.INSULT]) == [(0, t.PLAIN)]
    assert t.clause_events([t.NEGATION, t.OTHER, t.INSULT]) == [(2, t.NEGATED)]
    assert t.clause_events([t.NEGATION, t.OTHER, t.OTHER, t.OTHER, t.INSULT]) == [(4, t.PLAIN)]
    assert t.clause_events([t.REPORT] + [t.OTHER] * 9 + [t.INSULT]) == [(10, t.REPORTED)]
    assert t.clause_events([t.PERSON, t.OTHER, t.INSULT]) == [(2, t.AIMED)]
    assert t.clause_events([t.INSULT, t.PERSON]) == [(0, t.AIMED)]
    assert t.clause_events([t.WILL, t.HARM, t.PERSON]) == [(1, t.THREAT)]
    assert t.clause_events([t.HARM]) == []


# --- secrets -------------------------------------------------------------------------------------------


def slow_spans(text):
    text = text or ""
    found = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.ASCII):
        if len(m[2]) >= 12:
            found.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, r"AKIA[A-Z0-9]+", 18), (2, r"[0-9a-f]+", 16)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]


def test_base_spans_equal_brute_force():
    rng = random.Random(10)
    parts = ["PassWord", "token", "api_key", "apikey", "secret", "ſecret", '"', "'", " ", "=", ":", "AKIA", "ABCDEF12345678", "0123456789abcdef", "a", "Z9", "é", "\n", "-"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        got = [(secrets_scan.KINDS[k], a, b) for k, a, b, _ in secrets_scan.scan(text)[0]]
        assert got == slow_spans(text), text


def test_ownership_separates_copies(spark, docs_of):
    live, copied = "bearer: xK9fQ2mZ7pLw4RtV", "bearer: aB3dE5gH7jK9mN1q"
    rows = [(k, f"see {copied} here", "en", f"repo{k}") for k in range(6)] + [(10, f"my {live}", "en", "one"), (11, f"my {live}", "en", "one"), (11, f"my {live}", "en", "one")]
    rows += [(20, None), (None, live), (21, "")]
    got = secrets_scan.secret_spans(docs_of(rows)).collect()
    assert len(got) == len(rows)
    owned = defaultdict(set)
    for r in got:
        owned[r["doc_id"]].add(len(r["owned"]))
    assert all(owned[k] == {0} for k in (*range(6), 20, 21)) and owned[10] == owned[11] == {1}
    redacted = secrets_scan.redacted(docs_of(rows))
    assert redacted.schema == docs_of(rows).schema and redacted.count() == len(rows)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in redacted.collect()}
    assert texts[10] == ("my bearer: <secret>", 19) and texts[0][0] == rows[0][1] and texts[20] == (None, None)
    assert secrets_scan.secret_spans(docs_of([])).count() == 0


LIVE = "Zk3Qw9Lx7Tb2Vn5Rm8Yp4Hd6"


def test_holders_are_texts_not_copies(spark, docs_of):
    """Many texts of one source make an example; copies of one text in a source are one holder."""
    many = [(k, f"note {k} bearer: {LIVE}", "en", "src0") for k in range(40)]
    assert {len(r["owned"]) for r in secrets_scan.secret_spans(docs_of(many)).collect()} == {0}
    copies = [(k, f"my bearer: {LIVE}", "en", "src0") for k in range(40)]
    assert {len(r["owned"]) for r in secrets_scan.secret_spans(docs_of(copies)).collect()} == {1}
    few = [(k, f"note {k} bearer: {LIVE}", "en", "src0") for k in range(secrets_scan.MAX_TEXTS)]
    assert {len(r["owned"]) for r in secrets_scan.secret_spans(docs_of(few)).collect()} == {1}
    apart = [(k, f"note {k} bearer: {LIVE}", "en", f"src{k}") for k in range(3)]
    assert {len(r["owned"]) for r in secrets_scan.secret_spans(docs_of(apart)).collect()} == {0}


def test_redaction_with_any_column_names(spark):
    rows = [(1, f"my bearer: {LIVE}", "src0", 1, "a", 2, "b", "x"), (2, "clean", None, 1, "a", 2, "b", "y"), (None, None, "src0", 1, None, 2, "b", "z")]
    names = "doc_id long, text string, source string, _key long, _spans string, _id int, key string, spans string"
    docs = spark.createDataFrame(rows, names)
    found = secrets_scan.redacted(docs)
    assert found.schema == docs.schema
    assert sorted(found.collect(), key=str) == sorted([(1, "my bearer: <secret>", *rows[0][2:]), rows[1], rows[2]], key=str)


def test_candidates_inside_base_spans():
    """Merged base spans tell what each of them tells."""
    rng = random.Random(8)
    parts = ["token=", "auth: ", "0123456789abcdef", LIVE, "AKIA", "ABCDEF12345678", " ", "\n", "-", "é", "zz9"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 14)))
        base, more = secrets_scan.scan(text)
        assert not any(a < y and x < b for _, a, b, _ in more for _, x, y, _ in base)
        taken = [m[1:3] for m in more]
        found = [m.span() for m in secrets_scan.TOKEN.finditer(text)] + [m.span(1) for m in secrets_scan.NAMED.finditer(text)]
        for a, b in found:
            if secrets_scan.looks_alive(text[a:b]) and not any(a < y and x < b for _, x, y, _ in base):
                assert any(a < y and x < b for x, y in taken)


def test_query_eight(spark):
    want = {}
    for doc_id, text in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect():
        spans = slow_spans(text)
        n = Counter(k for k, _, _ in spans)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        want[doc_id] = (n["assign"], n["access"], n["hex"], hashlib.sha256(joined.encode()).hexdigest())
    got = queries.op8_ownership(spark, "/root/testdata/sf0.01").collect()
    assert {r["doc_id"]: tuple(r)[1:5] for r in got} == want
    assert sum(r["n_assign"] for r in got) > 0


# --- ring ----------------------------------------------------------------------------------------------


def slow_ring(keys, shards, vnodes):
    nodes, room, used, out = ring.ring(shards, vnodes), ring.capacities(len(keys), shards), [0] * shards, []
    cells = [c for c, _ in nodes]

    def cell(key):
        return int(hashlib.md5(str("" if key is None else key).encode()).hexdigest()[:4], 16) >> 2

    for key in sorted(keys, key=lambda k: (cell(k), k is not None, k or 0)):
        at = bisect_left(cells, cell(key))
        while used[nodes[at % len(nodes)][1]] >= room[nodes[at % len(nodes)][1]]:
            at += 1
        shard = nodes[at % len(nodes)][1]
        out.append((key, shard))
        used[shard] += 1
    return Counter(out)


@pytest.mark.parametrize("shards, vnodes, part_rows", [(24, 64, 10**6), (5, 3, 10), (1, 1, 7)])
def test_ring_equals_one_by_one(spark, docs_of, odd_rows, shards, vnodes, part_rows):
    rows = odd_rows + [(k, "t" * (k % 7)) for k in range(50, 250)] + [(77, "hot")] * 120
    got = ring.ring_shards(docs_of(rows), shards, vnodes, part_rows).collect()
    assert Counter((r["doc_id"], r["shard"]) for r in got) == slow_ring([i for i, _ in rows], shards, vnodes)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    sizes = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sizes


def test_ring_of_nothing_and_few_moves(spark, docs_of):
    assert ring.ring_shards(docs_of([])).count() == 0
    rows = [(k, "") for k in range(4000)]
    a, b = ({r["doc_id"]: r["shard"] for r in ring.ring_shards(docs_of(rows), n).collect()} for n in (8, 9))
    assert sum(a[k] != b[k] for k in a) < 0.45 * len(a)  # a modulus would move eight ninths
    plan = ring.ring_shards(docs_of(rows))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# --- archives ------------------------------------------------------------------------------------------


def test_audit_finds_every_damage(spark):
    rng = random.Random(11)
    pages = [(k, f"http://h/{k}", f"<p>{rng.random()}</p>" * rng.randint(0, 4)) for k in range(300)]
    pages += [(None, None, None), (5, *pages[5][1:]), (900, "u", None)]
    schema = "page_id long, url string, html string"
    changed, lost = {3, 77, 250, 900}, {11, 12, 299}
    copy = [(i, u, (h or "") + "!") if i in changed else (i, u, h) for i, u, h in pages if i not in lost] + [(1000, "new", "x")]
    got = fixity.audit(spark.createDataFrame(pages, schema), spark.createDataFrame(copy, schema), file_records=20).collect()
    want = {i: "changed" if i in changed else "missing" if i in lost else "ok" for i, _, _ in pages} | {1000: "extra"}
    assert {r["page_id"]: r["status"] for r in got} == want and len(got) == len(want)
    assert {r["copies"] for r in got if r["page_id"] == 5} == {2}
    same = fixity.audit(spark.createDataFrame(pages, schema), spark.createDataFrame(pages, schema), file_records=20)
    assert same.filter("status <> 'ok'").count() == 0
    none = spark.createDataFrame([], schema)
    assert fixity.audit(none, none).count() == 0


def test_only_differing_branches_are_descended(spark):
    schema = "page_id long, url string, html string"
    pages = [(k, "u", str(k)) for k in range(2000)]
    copy = [(i, u, "????" if i == 1234 else h) for i, u, h in pages]
    files = 100
    records = [fixity.materialize(fixity.leaves(spark.createDataFrame(p, schema), files), "t") for p in (pages, copy)]
    a, b = (fixity.Tree(r, files, fixity.depth_for(*records)) for r in records)
    assert a.root() and b.root() and a.root() != b.root()
    assert fixity.differing_blocks(a, b).count() == 1
    assert fixity.differing_blocks(a, a).count() == 0


# --- pipeline ------------------------------------------------------------------------------------------


def test_records_of_one_page_id_are_numbered_in_parts(spark):
    rng = random.Random(8)
    pages = [(rng.choice([7, 7, 7, None, -1, 3]), f"u{k % 3}", f"page {k % 300}" * (k % 4)) for k in range(900)]
    files = 3
    rows = fixity.leaves(spark.createDataFrame(pages, "page_id long, url string, html string"), files).collect()
    assert sum(r["copies"] for r in rows) == len(pages)
    by_file = defaultdict(list)
    for r in rows:
        by_file[r["file_no"]].append(r)
    size_of = {}
    for page_id, url, html in pages:
        name = "" if page_id is None else str(page_id)
        record = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{name}>\r\nWARC-Target-URI: {url}\r\nContent-Type: text/html\r\nContent-Length: {len(html)}\r\n\r\n{html}\r\n\r\n"
        size_of[page_id, hashlib.sha256(record.encode()).hexdigest()] = len(record)
    assert {(r["page_id"], r["sha256"]) for r in rows} == set(size_of) and len(rows) == len(size_of)
    for some in by_file.values():
        at = 0
        order = sorted(some, key=lambda r: (r["page_id"] is not None, r["page_id"] or 0, r["sha256"]))
        for place, r in enumerate(order):
            assert (r["place"], r["first"]) == (place, at)
            at += size_of[r["page_id"], r["sha256"]] * r["copies"]
            assert r["last"] == at



def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.schema, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = neardup.materialize(stage(spark, before, sf_dir), f"t-{name}")
        assert kept.schema == columns
        ids, rows = [r["doc_id"] for r in kept.select("doc_id").collect()], before.select("doc_id", "text").collect()
        assert len(ids) == len(set(ids)) and set(ids) <= {r["doc_id"] for r in rows}
        if name == "near_dedup":
            assert set(ids) == {i for i, (_, top) in slow_components([tuple(r) for r in rows]).items() if i == top}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            hits = slow_hits([r["text"] for r in rows], items, 13)
            assert set(ids) == {r["doc_id"] for r, (n, h, _) in zip(rows, hits) if not (h > 0 and 20 * h >= n)}
        if name == "secrets":
            assert len(ids) == len(rows)
            old = {r["doc_id"]: r["text"] for r in rows}
            for r in kept.collect():
                assert not slow_spans(r["text"]) and r["n_chars"] == len(r["text"])
                assert (r["text"] == old[r["doc_id"]]) == (not slow_spans(old[r["doc_id"]]))
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    fills = [r["n"] for r in packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()]
    assert max(fills) <= 2048 and len(fills) <= -(-sum(fills) // 2048) + 1
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == set(ids)


def test_pipeline_run_and_empty_input(spark, docs_of):
    assert corpus_pipeline.run(spark, SF).count() > 0
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
