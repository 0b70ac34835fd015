"""Toxicity by a weighted finite-state pattern grammar.

A lexical transducer maps each word to a class (insult, threat, target, negation, reported speech)
and a weight. Three machines read the classes of a clause: one of negation and one of reported
speech, which lower the weight of what follows, and one of targets, which raises the weight of
insults and threats near a person. They are composed into one deterministic machine, and a clause
scores the weights that the composed machine emits. A document is scored from its matched clauses.

The insult lexicon starts from general words, which labelled rows weigh, and is extended from those
rows: whole words and word beginnings that occur in toxic rows and hardly in clean ones. The clause features' logistic
weights are fitted on other labelled rows than the lexicon, where there are enough. Both use at most
`train_rows` labelled rows.

Null or empty texts have no clauses and get the score of a text without matches; null labels and
labels of no document are not learned from; repeated rows are scored each; without labels the
general words and default weights are used; other columns pass through, and columns named score or
predicted are replaced. Empty tables give no rows; long texts are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statuta.llm.common import at_most, checkpointed, release

TRAIN_ROWS = 24_000
LEXICON = 4_000
#: Log odds from which a term enters the lexicon, and at which it has the full weight.
LEAST, FULL = 2.0, 6.0
INSULT, THREAT, TARGET, NEGATION, REPORT = "ITGNR"
#: General words of each class.
WORDS = {
    INSULT: "idiot idiots moron morons stupid dumb fool loser losers scum trash pathetic worthless disgusting clown ugly filthy vermin dummkopf trottel abschaum idiota imbécil estúpido basura imbécile débile ordure",
    THREAT: "kill hurt destroy beat burn crush stab shoot töten umbringen schlagen tuer frapper détruire matar golpear destruir",
    TARGET: "you your you're he she they them him her these those du ihr euch sie dich tu vous toi ils elles tú usted ustedes ellos ellas",
    NEGATION: "not never no isn't aren't don't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún",
    REPORT: "said says wrote writes quoted reported claimed sagte sagt schrieb zitierte dit écrit déclaré dijo dice escribió",
}
PREFIXES = (5, 6, 7)
_CLAUSE = re.compile(r"[.!?;\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
FEATURES = 5


def _negation(state: int, kind: str) -> tuple[int, float]:
    if kind == NEGATION:
        return 3, 1.0
    return max(0, state - 1), 0.4 if state and kind in (INSULT, THREAT) else 1.0


def _reported(state: int, kind: str) -> tuple[int, float]:
    return (1, 1.0) if kind == REPORT else (state, 0.5 if state and kind in (INSULT, THREAT) else 1.0)


def _targeted(state: int, kind: str) -> tuple[int, float]:
    if kind == TARGET:
        return 4, 1.0
    return max(0, state - 1), 1.25 if state and kind in (INSULT, THREAT) else 1.0


def compose(machines) -> dict[tuple[int, str], tuple[int, float]]:
    """The product of several machines over the word classes: (state, class) to (state, factor)."""
    start = (0,) * len(machines)
    numbers, table, todo = {start: 0}, {}, [start]
    while todo:
        states = todo.pop()
        for kind in (INSULT, THREAT, TARGET, NEGATION, REPORT, ""):
            steps = [m(s, kind) for m, s in zip(machines, states, strict=True)]
            to = tuple(s for s, _ in steps)
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            table[numbers[states], kind] = numbers[to], float(np.prod([f for _, f in steps]))
    return table


GRAMMAR = compose((_negation, _reported, _targeted))


@dataclass
class Model:
    """A fitted grammar: term weights (a beginning ends in *), and logistic weights."""

    terms: dict[str, float]
    bias: float = -4.0
    weights: list[float] = field(default_factory=lambda: [1.5, 3.0, 60.0, 0.5, 0.5])

    def __post_init__(self):
        self.classes = {w: (kind, 0.5) for kind, listed in WORDS.items() for w in listed.split()}
        kinds = {w: kind for w, (kind, _) in self.classes.items()}
        self.classes.update({w: (kinds.get(w, INSULT), x) for w, x in self.terms.items() if w[-1] != "*"})
        self.starts = {w[:-1]: x for w, x in self.terms.items() if w[-1] == "*"}
        self.hits = {w for w, (kind, _) in self.classes.items() if kind in (INSULT, THREAT)}
        self.heads = {s[: PREFIXES[0]] for s in self.starts}

    def classify(self, word: str) -> tuple[str, float]:
        known = self.classes.get(word)
        if known is None and word[: PREFIXES[0]] in self.heads:
            known = max(((INSULT, self.starts[word[:n]]) for n in PREFIXES if word[:n] in self.starts), default=None)
        return known or ("", 0.0)

    def clause(self, words: list[str]) -> float:
        """Weight that the composed machine emits over a clause."""
        state, total = 0, 0.0
        for word in words:
            kind, weight = self.classify(word)
            state, factor = GRAMMAR[state, kind]
            if weight and kind in (INSULT, THREAT):
                total += weight * factor
        return total

    def features(self, text: str | None) -> list[float]:
        words_seen, scores, clauses = 0, [], 0
        for part in _CLAUSE.split((text or "").lower()):
            words = _WORD.findall(part)
            if words:
                clauses += 1
                words_seen += len(words)
                if any(w in self.hits or w[:5] in self.heads for w in words):
                    scores.append(self.clause(words))
        scores = [s for s in scores if s]
        total = sum(scores)
        return [np.log1p(total), max(scores, default=0.0) ** 0.5, total / max(words_seen, 20), np.log1p(len(scores)), len(scores) / max(clauses, 1)]

    def score(self, rows: list[list[float]]) -> np.ndarray:
        z = self.bias + np.array(rows).reshape(-1, FEATURES) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _terms(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    return {w for w in words if len(w) > 2} | {w[:n] + "*" for w in words for n in PREFIXES if len(w) > n}


def term_counts(rows: DataFrame) -> DataFrame:
    """term, toxic and clean: how many rows (text, toxic) of either label hold each term."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, found = batch.slice(at, 500), (Counter(), Counter())
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found[int(label)].update(_terms(text))
                terms = list(found[0] | found[1])
                counts = [pa.array([found[x][t] for t in terms], pa.int64()) for x in (1, 0)]
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *counts], names=["term", "toxic", "clean"])

    counts = rows.select("text", "toxic").mapInArrow(counted, "term string, toxic long, clean long")
    return counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Bias and weights by Newton's method."""
    x = np.column_stack((np.ones(len(x)), x))
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[0] = 1
    x = x / scale
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learns from at most `train_rows` rows of `labels` (doc_id, toxic), chosen by a hash."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", "toxic")
    sample = at_most(usable.distinct(), "doc_id", train_rows)
    rows = checkpointed(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))))
    sizes = {(r["half"], r["toxic"]): r["count"] for r in rows.groupBy("half", "toxic").count().collect()}
    toxic, clean = (sum(n for (_, t), n in sizes.items() if t == x) for x in (1, 0))
    if not toxic or not clean:
        return Model({})
    apart = min(sizes.get((h, 1), 0) for h in (0, 1)) >= 40
    own, other = (rows.where(F.col("half") == h) if apart else rows for h in (0, 1))
    n1, n0 = (sizes.get((0, x), 0) if apart else n for x, n in ((1, toxic), (0, clean)))
    # Lower bound of the log odds between toxic and clean rows, one standard error down.
    strength = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1)) - F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    known = [w for kind in (INSULT, THREAT) for w in WORDS[kind].split()]
    counted = term_counts(own).withColumn("strength", strength).where(((F.col("toxic") >= 4) & (F.col("strength") >= LEAST)) | F.col("term").isin(known))
    picked = counted.orderBy(F.desc("strength"), "term").limit(LEXICON).union(counted.where(F.col("term").isin(known))).collect()
    terms = {r["term"]: float(min(1.0, max(0.0, r["strength"] / FULL))) for r in picked}
    model = Model(terms)

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([model.features(t) for t in batch["text"]], columns=[f"f{i}" for i in range(FEATURES)], dtype="float64")
            yield out.assign(toxic=batch["toxic"].to_numpy())

    schema = ", ".join([f"f{i} double" for i in range(FEATURES)] + ["toxic int"])
    found = other.select("text", F.col("toxic").cast("int").alias("toxic")).mapInPandas(measured, schema).toPandas()
    w = logistic(found.iloc[:, :FEATURES].to_numpy(), found["toxic"].to_numpy())
    return Model(terms, float(w[0]), [float(x) for x in w[1:]])


def score(text: Column, model: Model) -> Column:
    """Column of the toxicity of `text`, 0 to 1."""

    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        # A few texts at a time, so that a batch is never held as Python strings.
        parts = [model.score([model.features(t.as_py()) for t in texts[at : at + 200]]) for at in range(0, len(texts), 200)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return scored(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """`docs` with score and predicted (1 if score >= threshold)."""
    model = fit(docs, labels, train_rows)
    release(docs.sparkSession)
    return docs.withColumn("score", score(F.col("text"), model)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
