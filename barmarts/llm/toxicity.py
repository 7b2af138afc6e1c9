"""Operator 1: toxicity by a weighted finite-state pattern grammar.

Five small transducers read the words of a clause together: the lexicon turns words into
classes (insult, threat, target, negation, reporting verb, other); the target machine
strengthens insults in a clause that addresses someone; the negation machine weakens what
follows a negation within a few words; the reported-speech machine weakens what follows a
reporting verb; the threat machine scores a threat word that meets a target nearby. They
are composed into one table, and a clause's score is the weight of its path, so the same
word counts differently by its clause. A document's score is a calibrated logistic of its
clauses' scores.

Insult words and word beginnings are learned from labelled documents: those that occur in
many different contexts (neighbouring words) of toxic documents and hardly in others; copies
of one text count once that way. Learning takes at most about ``SAMPLE_TOXIC`` and
``SAMPLE_CLEAN`` labelled rows, chosen by a hash of doc_id; the calibration uses a third of
them that the lexicon has not seen. Scoring reads every whole text, in Arrow batches.

Defined results: null, empty and word-less texts get the score of a text without any
matched clause; repeated rows are scored one by one; several labels of one doc_id count as
given; labels that are null are ignored; without labels a small fixed lexicon is used;
an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import ship_package

SAMPLE_TOXIC = 800
SAMPLE_CLEAN = 2400
STEMS = (4, 5, 6)
MIN_RATIO = 20.0
CACHE_WORDS = 300_000

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

# Function words of the four languages that the classes start from.
TARGETS = "you your yourself they them he she du dich dir ihr euch sie er usted ustedes tú te ellos él ella vous tu toi ils lui elle".split()
NEGATIONS = "not no never neither nicht kein keine nie niemals nunca ningún jamás ne pas jamais aucun".split()
REPORTS = "said says called wrote quoted claimed sagte nannte schrieb behauptete dijo llamó escribió dit appelé écrit".split()
THREATS = "kill hurt destroy beat töten vernichten matar destruir tuer détruire".split()
INSULTS = "idiot moron scum stupid pathetic worthless loser".split()

tokens_of = re.compile(r"[^\W\d_]+|[.!?;:\n]").findall
ENDS = frozenset(".!?;:\n")


@dataclass
class Transducer:
    """A deterministic weighted transducer over word classes; state 0 is the start.

    ``arcs`` maps (state, class) to (next state, factor, addend); a missing arc stays in the
    state named by ``rest`` with factor 1 and addend 0.
    """

    states: int
    arcs: dict[tuple[int, int], tuple[int, float, float]]
    rest: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, kind: int) -> tuple[int, float, float]:
        return self.arcs.get((state, kind), (self.rest.get(state, state), 1.0, 0.0))


def compose(*machines: Transducer) -> list[list[tuple[int, float, float]]]:
    """Product machine as a table: factors multiply, addends add."""
    places = {s: i for i, s in enumerate(product(*[range(m.states) for m in machines]))}
    table = []
    for states in places:
        row = []
        for kind in range(6):
            steps = [m.step(s, kind) for m, s in zip(machines, states)]
            factor, addend = 1.0, 0.0
            for _, f, a in steps:
                factor, addend = factor * f, addend + a
            row.append((places[tuple(s[0] for s in steps)], factor, addend))
        table.append(row)
    return table


def grammar(scope: int = 3, reach: int = 4) -> list[list[tuple[int, float, float]]]:
    insult = Transducer(1, {})  # the weight of an insult comes from the lexicon
    target = Transducer(2, {(0, TARGET): (1, 1.0, 0.0), (1, INSULT): (1, 1.5, 0.0)})
    negation = Transducer(scope + 1, {(s, NEGATION): (scope, 1.0, 0.0) for s in range(scope + 1)}
                          | {(s, INSULT): (s - 1, 0.5, 0.0) for s in range(1, scope + 1)},
                          {s: s - 1 for s in range(1, scope + 1)})
    reported = Transducer(2, {(0, REPORT): (1, 1.0, 0.0), (1, INSULT): (1, 0.7, 0.0)})
    threat = Transducer(reach + 1, {(s, THREAT): (reach, 1.0, 0.0) for s in range(reach + 1)}
                        | {(s, TARGET): (0, 1.0, 1.0) for s in range(1, reach + 1)},
                        {s: s - 1 for s in range(1, reach + 1)})
    return compose(insult, target, negation, reported, threat)


class Model:
    """Lexicon, composed grammar and calibration."""

    def __init__(self, weights: dict[str, float], stems: dict[str, float]):
        self.table = grammar()
        self.weights, self.stems = weights, stems
        self.fixed = ({w: TARGET for w in TARGETS} | {w: NEGATION for w in NEGATIONS} | {w: REPORT for w in REPORTS}
                      | {w: THREAT for w in THREATS})
        self.coefficients = np.array([-3.0, 2.0, 0.5])
        self.cache: dict[str, tuple[int, float]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}}

    def classify(self, token: str) -> tuple[int, float]:
        """Lexicon transducer: class of a word and, for insults, its weight."""
        found = self.cache.get(token)
        if found is None:
            if len(self.cache) > CACHE_WORDS:
                self.cache.clear()
            word = token.lower()
            weight = max([self.weights.get(word, 0.0), *(self.stems.get(word[:k], 0.0) for k in STEMS if len(word) > k)])
            found = (INSULT, weight) if weight > 0 else (self.fixed.get(word, OTHER), 0.0)
            self.cache[token] = found
        return found

    def features(self, text: str | None) -> tuple[float, float]:
        """Sum and maximum of the clauses' scores."""
        tokens = tokens_of(text) if text else []
        get, classify = self.cache.get, self.classify
        read = [get(t) or classify(t) for t in tokens]
        if not any(kind == INSULT or kind == THREAT for kind, _ in read):
            return 0.0, 0.0
        total = most = clause = 0.0
        state, table = 0, self.table
        for token, (kind, weight) in zip(tokens, read):
            if token in ENDS:
                total, most, clause, state = total + clause, max(most, clause), 0.0, 0
                continue
            state, factor, addend = table[state][kind]
            clause += weight * factor + addend
        return total + clause, max(most, clause)

    def score(self, text: str | None) -> float:
        total, most = self.features(text)
        return float(1 / (1 + np.exp(-np.dot(self.coefficients, [1.0, np.log1p(total), np.log1p(most)]))))


def learn_lexicon(toxic: list[str], clean: list[str]) -> tuple[dict[str, float], dict[str, float]]:
    """Weights of words and word beginnings, by the number of different contexts on each side."""
    def contexts(texts: list[str]) -> tuple[Counter, int]:
        seen: dict[tuple[str, bool], set[int]] = defaultdict(set)
        places: set[int] = set()
        for text in texts:
            words = [w for w in tokens_of(text.lower()) if w not in ENDS]
            for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                at = hash((before, after))
                places.add(hash((before, word, after)))
                seen[word, True].add(at)
                for k in STEMS:
                    if len(word) > k:
                        seen[word[:k], False].add(at)
        return Counter({k: len(v) for k, v in seen.items()}), len(places)

    (bad, n_bad), (good, n_good) = contexts(toxic), contexts(clean)
    least = max(5, len(toxic) // 100)
    words, stems = {}, {}
    for (name, whole), t in bad.items():
        ratio = ((t + 0.5) / (n_bad + 1)) / ((good[name, whole] + 0.5) / (n_good + 1))
        if t >= least and ratio >= MIN_RATIO:
            (words if whole else stems)[name] = float(min(4.0, np.log(ratio) / 2))
    return words, stems


def calibrate(model: Model, texts: list[str], toxic: list[int]) -> None:
    """Logistic regression of the label on the clause scores (Newton steps, small ridge)."""
    if len(set(toxic)) < 2:
        return
    x = np.array([[1.0, np.log1p(a), np.log1p(b)] for a, b in map(model.features, texts)])
    y, w, ridge = np.array(toxic, float), np.zeros(3), np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    if w[1] > 0 or w[2] > 0:  # more matched clauses never lower a score
        w[1:] = np.maximum(w[1:], 0.0)
        model.coefficients = w


def train(rows: list[tuple[str, int]]) -> Model:
    """``rows``: (text, toxic 0/1)."""
    rows = sorted(rows)
    fresh = [r for k, r in enumerate(rows) if k % 3 == 2]
    learned = [r for k, r in enumerate(rows) if k % 3 != 2] if len({t for _, t in fresh}) == 2 else rows
    words, stems = learn_lexicon([t for t, y in learned if y == 1], [t for t, y in learned if y == 0])
    model = Model({**{w: 2.0 for w in INSULTS}, **words}, stems)
    calibrate(model, *map(list, zip(*(fresh if learned is not rows else rows)))) if rows else None
    return model


def fit(docs: DataFrame, labels: DataFrame, use: Column, n_toxic: int = SAMPLE_TOXIC, n_clean: int = SAMPLE_CLEAN) -> Model:
    """Train on a bounded sample of labelled documents; ``use`` (over doc_id) admits rows."""
    known = labels.where(use & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    shares = [int(min(1.0, n / max(1, sizes.get(k, 0))) * (1 << 30)) for k, n in ((0, n_clean), (1, n_toxic))]
    part = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30))
    sample = known.where(part < F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0]))
    rows = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")
    return train([(r.text, r.toxic) for r in rows.toLocalIterator()])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
