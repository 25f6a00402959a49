"""Toxicity by a weighted finite-state grammar over clauses.

A text falls into clauses at ``. ! ? ; :`` and line ends, a clause into words (letters, lower-cased). Word classes
come from a lexicon automaton learned from labels and from small fixed lists; four transducers read the classes:

- negation: an insult within three words after a negation becomes a negated one;
- reported speech: insults after a verb of saying, up to the end of the clause, become reported ones;
- target: an insult within four words of a word that names a person becomes an aimed one;
- threat: a word of intent followed within three words by a word of violence is a threat.

They are composed once into one table. A clause is scored by the events it yields, not by isolated words; a
text's features are the sums of lexicon weights per kind of event, and a logistic model turns them into a score.

Learned on labelled rows (at most ``max_train``, those with the smallest hash of their id):

- the lexicon: words and word beginnings of 4 to 8 letters with their document counts in both classes. A word's
  weight is the log odds of the longest known beginning, each shrunk towards the next shorter one;
- the model. A training row's own counts are taken out of the lexicon before its features are computed.

Null texts count as empty ones and score what a text without events scores; rows with null labels or labels of
unknown ids teach nothing; repeated rows are scored alike; with no labels the fixed lists alone decide.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import by_batch, materialize, settled_crc, texts_of

MAX_TRAIN = 20_000
PREFIXES = (4, 5, 6, 7, 8)
MIN_ROWS = 5
SHRINK = 8.0
INSULT_WEIGHT = 1.8
MAX_WORDS = 200_000

# Seed words of the grammar in the languages of the corpus.
INSULTS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown",
           "idiota", "estúpido", "imbécil", "crétin", "imbécile", "dummkopf", "trottel", "abschaum")
NEGATIONS = ("not", "never", "no", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "jamás")
SAYING = ("said", "says", "called", "wrote", "quoted", "claimed", "sagte", "schrieb", "nannte", "dit", "écrit", "appelé", "dijo", "escribió", "llamó")
PERSONS = ("you", "your", "he", "she", "they", "him", "them", "du", "dich", "dein", "ihr", "sie", "tu", "vous", "toi", "ellos", "usted", "tú")
INTENT = ("will", "gonna", "shall", "going", "werde", "vais", "voy")
VIOLENCE = ("kill", "hurt", "beat", "destroy", "shoot", "stab", "töten", "schlagen", "tuer", "frapper", "matar", "golpear")
SEED_WEIGHT = 2.5

# Classes of words and the events of clauses.
OTHER, INSULT, NEGATION, REPORT, PERSON, WILL, HARM = range(7)
PLAIN, AIMED, NEGATED, REPORTED, THREAT = range(5)
EVENTS = 5
PRIOR = np.array([-3.0, 1.0, 1.0, 0.5, 0.5, 1.0])

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:\n]")


class Transducer:
    """States from 0, and for a state and a class the next state; a state may mark what is read in it."""

    def __init__(self, size: int, step):
        self.size, self.step = size, step


def _countdown(cls: int, reach: int) -> Transducer:
    """State k > 0: within k words after a word of class ``cls``."""
    return Transducer(reach + 1, lambda state, c: reach if c == cls else max(0, state - 1))


def _after(cls: int) -> Transducer:
    return Transducer(2, lambda state, c: 1 if c == cls else state)


def compose(*parts: Transducer) -> tuple[list[list[int]], list[tuple[int, ...]]]:
    """One table for several transducers read at once: next state by state and class, and what each state means."""
    states = list(itertools.product(*(range(p.size) for p in parts)))
    number = {s: k for k, s in enumerate(states)}
    table = [[number[tuple(p.step(x, c) for p, x in zip(parts, s))] for c in range(7)] for s in states]
    return table, states


TABLE, STATES = compose(_countdown(NEGATION, 3), _after(REPORT), _countdown(PERSON, 4), _countdown(WILL, 3))


def clause_events(classes: list[int]) -> list[tuple[int, int]]:
    """``(position, event)`` for the insults and threats of a clause."""
    state, events = 0, []
    for i, c in enumerate(classes):
        negated, reported, person, will = STATES[state]
        if c == INSULT:
            if negated:
                event = NEGATED
            elif reported:
                event = REPORTED
            elif person or PERSON in classes[i + 1 : i + 5]:
                event = AIMED
            else:
                event = PLAIN
            events.append((i, event))
        elif c == HARM and will and not negated:
            events.append((i, THREAT))
        state = TABLE[state][c]
    return events


class Lexicon:
    """Counts of words (closed by ``$``) and word beginnings in toxic and in all training texts."""

    def __init__(self, counts: dict[str, tuple[int, int]], n_toxic: int, n_all: int):
        self.counts, self.n_toxic, self.n_all = counts, n_toxic, n_all
        self.fixed = {w: c for c, words in ((NEGATION, NEGATIONS), (REPORT, SAYING), (PERSON, PERSONS), (WILL, INTENT), (HARM, VIOLENCE)) for w in words}
        self.seeds = frozenset(INSULTS)
        self.known: dict[str, tuple[int, float]] = {}

    def weight(self, word: str, less: tuple[int, int] | None = None) -> float:
        """Log odds of a text with this word against any text; ``less``: what one row adds to every count."""
        toxic, rows = self.n_toxic, self.n_all
        if less:
            toxic, rows = toxic - less[0], rows - less[1]
        base = (toxic + 0.5) / (rows + 5.0)
        share, seen = base, False
        for node in nodes_of(word):
            t, n = self.counts.get(node, (0, 0))
            if less and n:
                t, n = t - less[0], n - less[1]
            if n < MIN_ROWS:
                continue
            seen = True
            share = (t + SHRINK * share) / (n + SHRINK)
        if not seen:
            return SEED_WEIGHT if word in self.seeds else 0.0
        learned = math.log(share / (1 - share)) - math.log(base / (1 - base))
        return max(learned, SEED_WEIGHT) if word in self.seeds else learned

    def classify(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            weight = self.weight(word)
            found = (INSULT, weight) if weight >= INSULT_WEIGHT else (self.fixed.get(word, OTHER), 0.0)
            if len(self.known) > MAX_WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def features(self, text: str, label: int | None = None) -> list[float]:
        """Sums of weights by kind of event; with a label, as if the text had not been a training text."""
        sums = [0.0] * EVENTS
        low = text.lower()
        known, classify = self.known, self.classify
        less = None if label is None else (label, 1)
        for clause in _CLAUSE.split(low):
            words = _WORD.findall(clause)
            read = [known.get(w) or classify(w) for w in words]
            if less:
                read = [self._without(w, r, less) for w, r in zip(words, read)]
            classes = [r[0] for r in read]
            if INSULT in classes or HARM in classes:
                for i, event in clause_events(classes):
                    sums[event] += read[i][1] or SEED_WEIGHT
        return [math.log1p(s) for s in sums]

    def _without(self, word: str, read: tuple[int, float], less: tuple[int, int]) -> tuple[int, float]:
        if read[0] != INSULT:
            return read
        weight = self.weight(word, less)
        return (INSULT, weight) if weight >= INSULT_WEIGHT else (self.fixed.get(word, OTHER), 0.0)


def nodes_of(word: str) -> list[str]:
    """The states a word passes in the lexicon, shortest beginning first, the whole word last."""
    return [word[:k] for k in PREFIXES if len(word) >= k] + [word + "$"]


def _count_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, rows = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            nodes = {node for word in set(_WORD.findall(text.lower())) for node in nodes_of(word)}
            rows.update(nodes)
            if label:
                toxic.update(nodes)
    for start in range(0, len(order := list(rows)), 20_000):
        some = order[start : start + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([toxic[x] for x in some], pa.int64()), pa.array([rows[x] for x in some], pa.int64())], names=["node", "toxic", "n"])


def training_rows(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, text, toxic`` of at most ``max_train`` labelled rows outside the held-out fifth."""
    chosen = labels.select(F.col("doc_id").alias("label_id"), F.col("toxic").cast("int").alias("toxic"))
    chosen = chosen.filter("label_id IS NOT NULL AND toxic IN (0, 1)").filter(settled_crc(F.col("label_id")) % 5 != 0)
    chosen = chosen.groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("label_id"), "label_id").limit(max_train)
    texts = texts_of(docs)
    found = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["label_id"])
    return found.select("doc_id", "text", "toxic").dropDuplicates(["doc_id"])


class Model:
    """A lexicon and the weights of a logistic model on its features."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray):
        self.lexicon, self.weights = lexicon, weights

    def score(self, text: str) -> float:
        x = float(self.weights[0] + np.dot(self.weights[1:], self.lexicon.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Learn lexicon and model. The driver gets the counts of the lexicon, which ``max_train`` texts bound, and ``max_train`` short vectors."""
    rows = materialize(training_rows(docs, labels, max_train), "toxicity-train")
    n_all, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    counted = rows.select("text", "toxic").mapInArrow(_count_nodes, "node string, toxic long, n long")
    counted = counted.groupBy("node").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    counted = materialize(counted.filter(F.col("n") >= MIN_ROWS), "toxicity-nodes")
    counted = counted.withColumn("stem", F.substring("node", 1, PREFIXES[0]))
    # what is likelier in toxic texts, and, below the same beginnings, the words that are not
    lift = F.col("toxic") * max(1, n_all) > 2 * F.col("n") * max(1, n_toxic)
    telling = counted.filter((F.col("toxic") >= MIN_ROWS) & lift).select("stem").distinct()
    known = counted.join(telling, "stem", "left_semi").select("node", "toxic", "n").toArrow()
    node, toxic, n = (known.column(c).to_pylist() for c in ("node", "toxic", "n"))
    lexicon = Lexicon(dict(zip(node, zip(toxic, n))), n_toxic, n_all)
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.counts, n_toxic, n_all))

    def learn():
        own = Lexicon(*shared.value)

        def step(batch: pa.RecordBatch) -> dict:
            labels = batch.column("toxic").to_pylist()
            return {"x": [own.features(t, y) for t, y in zip(batch.column("text").to_pylist(), labels)], "y": labels}

        return step

    vectors = by_batch(rows.select("doc_id", "text", "toxic"), learn, "x array<double>, y int").collect()
    return Model(lexicon, fit(np.array([r["x"] for r in vectors]).reshape(-1, EVENTS), np.array([r["y"] for r in vectors], float)))


def fit(x: np.ndarray, y: np.ndarray, strength: float = 1.0) -> np.ndarray:
    """Logistic weights (first the constant), drawn towards ``PRIOR``, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = PRIOR.copy()
    pull = np.full(EVENTS + 1, strength)
    pull[0] = 0.01
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, gradient)
        w = w - step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-8:
            break
    return w


def _scorer(shared):
    def make():
        counts, n_toxic, n_all, weights = shared.value
        model = Model(Lexicon(counts, n_toxic, n_all), weights)

        def step(batch: pa.RecordBatch) -> dict:
            scores = [model.score(t) for t in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id"), "score": scores}

        return step

    return make


def shared_model(docs: DataFrame, model: Model):
    lexicon = model.lexicon
    return docs.sparkSession.sparkContext.broadcast((lexicon.counts, lexicon.n_toxic, lexicon.n_all, model.weights))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    texts = texts_of(docs)
    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = by_batch(texts, _scorer(shared_model(docs, model)), f"doc_id {kind}, score double")
    return scored.select("doc_id", (settled_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    shared = shared_model(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n_toxic, n_all, weights = shared.value
        own = Model(Lexicon(counts, n_toxic, n_all), weights)
        for batch in batches:
            keep = [own.score(t or "") < 0.5 for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))
        pa.default_memory_pool().release_unused()  # the worker outlives the task

    return docs.mapInArrow(run, docs.schema)
