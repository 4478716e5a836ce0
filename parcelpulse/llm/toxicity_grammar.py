"""Toxicity: a weighted finite-state grammar over clauses, with learned weights.

Words become symbols: insult, target, negation, report, intent, harm or other. Small
transducers read them: insults carry their own weight, a target beside an insult, a negation shortly
before it and reported speech around it are marked, and intent, harm and target in a row are a
threat. Their composition reads a clause once and puts out the marks of its heaviest reading.

Labels set the weights. Stems (word beginnings, and whole words) that occur in toxic rows and
hardly elsewhere are the insults; a logistic model over the marks of a text's heaviest clause
makes its score. Both are fitted on at most about ``FIT_ROWS`` labelled rows, chosen by hash,
none of them held out, beside a few general words; without labels of both kinds these and set
weights serve alone.

A null or empty text has no clause and gets the score of a text without marks. A row with a null
doc_id has no label and is not held out. Only the text is an input of a score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelpulse.llm.common import map_arrow, whole_text

FIT_ROWS = 20_000
MAX_STEMS = 5_000
STEM_LENGTHS = (3, 4, 5, 6, 7, 8)
LEAST_SHARE = 0.95  # of the rows with a stem that are toxic
LEAST_SUPPORT = 0.02  # of the toxic rows that have it, and four of them
THRESHOLD = 0.7

# Words of the grammar, in the languages of the corpus.
TARGETS = "you your yourself u he she they them him her tu vous toi du ihr dich euch tú usted ustedes".split()
NEGATIONS = "not never isn't aren't don't kein keine nicht pas jamais nunca".split()
REPORTS = "said says saying wrote writes quote quoted called calls claimed told sagte sagt dit dijo".split()
INTENTS = "will gonna going shall must should werde voy vais".split()
HARMS = "kill hurt destroy murder shoot stab beat strangle töten matar tuer".split()
GENERAL_INSULTS = "idiot moron scum loser stupid worthless pathetic disgusting trash".split()

MARKS = ("insult", "weight", "target", "negated", "reported", "threat")
SET_WEIGHTS = np.array([-4.0, 2.0, 0.6, 0.5, -1.0, -1.0, 5.5])  # intercept, then MARKS

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE = re.compile(r"[.!?;:\n]+")


@dataclass(frozen=True)
class Transducer:
    """``moves[state, symbol]`` is (next state, marks put out); a missing move stays silent."""

    start: object
    states: tuple
    moves: dict

    def step(self, state, symbol):
        return self.moves.get((state, symbol), (state, frozenset()))


SYMBOLS = ("insult", "target", "negation", "report", "intent", "harm", "other")


def _insults() -> Transducer:
    return Transducer(0, (0,), {(0, "insult"): (0, frozenset(["insult"]))})


def _targets() -> Transducer:
    seen = frozenset(["target"])
    return Transducer(
        "none",
        ("none", "target", "insult"),
        {
            ("none", "target"): ("target", frozenset()),
            ("target", "insult"): ("target", seen),
            ("none", "insult"): ("insult", frozenset()),
            ("insult", "target"): ("target", seen),
        },
    )


def _negations(reach: int = 3) -> Transducer:
    moves = {}
    for state in range(reach + 1):
        for symbol in SYMBOLS:
            marks = frozenset(["negated"]) if state and symbol == "insult" else frozenset()
            moves[state, symbol] = (reach if symbol == "negation" else max(state - 1, 0), marks)
    return Transducer(0, tuple(range(reach + 1)), moves)


def _reports() -> Transducer:
    return Transducer(
        0, (0, 1), {(0, "report"): (1, frozenset()), (1, "insult"): (1, frozenset(["reported"]))}
    )


def _threats() -> Transducer:
    moves = {(s, symbol): (0, frozenset()) for s in (1, 2) for symbol in SYMBOLS}
    moves |= {(s, "intent"): (1, frozenset()) for s in (0, 1, 2)}
    moves[1, "harm"] = (2, frozenset())
    moves[2, "target"] = (0, frozenset(["threat"]))
    moves[1, "other"] = (1, frozenset())
    return Transducer(0, (0, 1, 2), moves)


def compose(machines: list[Transducer]) -> Transducer:
    """One machine that runs all at once and puts out the marks of all."""
    states = tuple(product(*(m.states for m in machines)))
    moves = {}
    for state in states:
        for symbol in SYMBOLS:
            steps = [m.step(s, symbol) for m, s in zip(machines, state, strict=True)]
            moves[state, symbol] = (tuple(s for s, _ in steps), frozenset().union(*(o for _, o in steps)))
    return Transducer(tuple(m.start for m in machines), states, moves)


def grammar() -> Transducer:
    return compose([_insults(), _targets(), _negations(), _reports(), _threats()])


FUNCTION_WORDS = {
    w: symbol
    for symbol, words in (
        ("harm", HARMS),
        ("intent", INTENTS),
        ("report", REPORTS),
        ("negation", NEGATIONS),
        ("target", TARGETS),
    )
    for w in words
}


def stems(word: str) -> list[str]:
    """Beginnings of a word, and the word itself, marked at its end."""
    return [word[:k] for k in STEM_LENGTHS if k <= len(word)] + [word + "$"]


class Reader:
    """Marks of texts under a lexicon of stems and their weights."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.machine = grammar()
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 500_000:
                self.known.clear()
            found = max((self.lexicon.get(s, 0.0) for s in stems(word)), default=0.0)
            self.known[word] = found
        return found

    def clause(self, words: list[str]) -> np.ndarray:
        marks = np.zeros(len(MARKS))
        state = self.machine.start
        for word in words:
            weight = self.weight(word)
            symbol = "insult" if weight else FUNCTION_WORDS.get(word, "other")
            state, out = self.machine.step(state, symbol)
            for mark in out:
                marks[MARKS.index(mark)] = 1.0
            if "insult" in out:
                marks[1] = max(marks[1], weight)
        return marks

    def text(self, text: str) -> tuple[np.ndarray, int]:
        """Marks of the heaviest clause, and how many clauses have an insult or a threat."""
        lower = text.lower()
        best, matched = np.zeros(len(MARKS)), 0
        words = set(WORD.findall(lower))
        if any(map(self.weight, words)) or not words.isdisjoint(HARMS):
            for clause in CLAUSE.split(lower):
                marks = self.clause(WORD.findall(clause))
                if marks[0] or marks[5]:
                    matched += 1
                    if (marks @ SET_WEIGHTS[1:]) > (best @ SET_WEIGHTS[1:]):
                        best = marks
        return best, matched


def _stem_counts(batch: pa.RecordBatch):
    counts = {0: Counter(), 1: Counter()}
    for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
        found = {s for w in set(WORD.findall(text.lower())) for s in stems(w)}
        counts[label].update(found)
    for label, counter in counts.items():
        yield pa.record_batch(
            {
                "stem": pa.array(list(counter), pa.string()),
                "label": pa.array([label] * len(counter), pa.int32()),
                "n": pa.array(list(counter.values()), pa.int64()),
            }
        )


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Weights of at most ``MAX_STEMS`` stems from ``rows`` (``text``, ``label``)."""
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    general = dict.fromkeys((w + "$" for w in GENERAL_INSULTS), 4.0)
    if len(sizes) < 2:
        return general
    counted = map_arrow(rows, _stem_counts, "stem string, label int, n bigint").groupBy("stem")
    both = counted.agg(F.sum(F.expr("n * label")).alias("toxic"), F.sum("n").alias("all"))
    weight = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1)) - F.log(
        (F.col("all") - F.col("toxic") + 0.5) / (sizes[0] + 1)
    )
    found = (
        both.where(F.col("toxic") >= max(4.0, LEAST_SUPPORT * sizes[1]))
        .where(F.col("toxic") >= LEAST_SHARE * F.col("all"))
        .select("stem", weight.alias("weight"))
        .orderBy(F.desc("weight"), "stem")
        .limit(MAX_STEMS)
    )
    return general | {r["stem"]: float(r["weight"]) for r in found.collect() if r["weight"] > 0}


def _marks(lexicon: dict[str, float]):
    reader = Reader(lexicon)

    def work(batch: pa.RecordBatch):
        found = [reader.text(t)[0] for t in batch.column("text").to_pylist()]
        yield pa.record_batch({"label": batch.column("label"), "marks": pa.array([m.tolist() for m in found])})

    return work


def fit(marks: np.ndarray, labels: np.ndarray, rounds: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights (intercept first) by Newton's method, drawn to the set ones."""
    x = np.column_stack([np.ones(len(marks)), marks])
    w = SET_WEIGHTS.copy()
    pull = np.full(x.shape[1], ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (labels - p) - pull * (w - SET_WEIGHTS)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        w = w + np.linalg.solve(curve, slope)
    return w


@dataclass(frozen=True)
class Model:
    lexicon: dict
    weights: np.ndarray


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learned from: crc32 of the id as text leaves 1 modulo 3."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled rows that are not held out, ``FIT_ROWS`` of them or few more."""
    usable = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .where(~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    n = usable.count()
    if n > FIT_ROWS:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * FIT_ROWS / n))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).join(
        F.broadcast(usable), "doc_id"
    )
    lexicon = learn_lexicon(rows.select("text", "label"))
    seen = map_arrow(rows.select("text", "label"), _marks(lexicon), "label int, marks array<double>").collect()
    labels_seen = np.array([r["label"] for r in seen], float)
    if len(set(labels_seen.tolist())) < 2:
        return Model(lexicon, SET_WEIGHTS)
    return Model(lexicon, fit(np.array([r["marks"] for r in seen]), labels_seen))


def _score(model: Model):
    reader = Reader(model.lexicon)

    def work(batch: pa.RecordBatch):
        best, matched = [], []
        for text in batch.column("text").to_pylist():
            marks, n = reader.text(text)
            best.append(marks)
            matched.append(n)
        level = model.weights[0] + np.array(best).reshape(-1, len(MARKS)) @ model.weights[1:]
        keep = {c: batch.column(c) for c in batch.schema.names if c != "text"}
        yield pa.record_batch(
            keep
            | {
                "score": 1 / (1 + np.exp(-np.clip(level, -30, 30))),
                "n_clauses": pa.array(matched, pa.int64()),
            }
        )

    return work


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``n_clauses`` for each row of ``docs``."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), whole_text().alias("text")
    )
    schema = "doc_id bigint, held_out boolean, score double, n_clauses bigint"
    return map_arrow(rows, _score(model), schema).select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_clauses",
    )


def _keep(model: Model):
    reader = Reader(model.lexicon)

    def work(batch: pa.RecordBatch):
        best = [reader.text(t or "")[0] for t in batch.column("text").to_pylist()]
        level = model.weights[0] + np.array(best).reshape(-1, len(MARKS)) @ model.weights[1:]
        yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(level, -30, 30))) < THRESHOLD))

    return work


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic."""
    return map_arrow(docs, _keep(model), docs.schema)
