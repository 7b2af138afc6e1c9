"""Operator 6: language identification from averaged hashed subword embeddings.

A text's letters are lower-cased and grouped into words; every run of 1 to 4 letters, with a
mark at word starts and ends, is a subword. Each subword is hashed to a row of an embedding
table, the rows are averaged over the text, and a linear softmax gives the languages'
probabilities. Table and softmax are trained together by stochastic gradient descent in
numpy, on at most about ``per_language`` labelled documents of each language (chosen by a
hash of doc_id, so the sample does not grow with the input). A fifth of the sample is held
back: it sets the temperature of the probabilities, and the score under which ``accepted``
is false (the share of held-back documents under it is ``reject_share``).

Averaging and a linear layer commute, so scoring uses one table of class scores per subword
(buckets x languages), sent to the workers as a broadcast of fixed size. Whole texts are
scored in Arrow batches, long ones in pieces, nothing is shuffled.

Defined results: null texts and texts without a letter give ``und`` with score 0 and are not
accepted; ties go to the first language in sorted order; repeated rows are judged one by
one; without any labelled text every text with a letter gives ``und``; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barmarts.llm.common import ship_package


BUCKETS = 1 << 15
DIM = 16
LENGTHS = (1, 2, 3, 4)
PER_LANGUAGE = 400
SAMPLE_ROWS = 400_000
MAX_LANGUAGES = 10_000
PIECE = 1 << 20
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def subword_blocks(text: str, piece: int | None = None) -> Iterator[np.ndarray]:
    """Bucket of every subword of the text, one array for every ``piece`` characters."""
    text, piece, longest = f" {text.lower()} ", piece or PIECE, max(LENGTHS) - 1
    points, letter, after_letter = np.empty(0, np.uint64), np.empty(0, bool), True
    for start in range(0, len(text), piece):
        new = np.frombuffer(text[start:start + piece].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = _letter_table()[new]
        # marks: one blank stands for any run of other characters
        keep = is_letter | np.concatenate([[after_letter], is_letter[:-1]])
        after_letter = is_letter[-1]
        points, letter = points[-longest:], letter[-longest:]
        seen = len(points)  # subwords that end in these were in the block before
        points = np.concatenate([points, np.where(is_letter, new, 32)[keep].astype(np.uint64)])
        letter = np.concatenate([letter, is_letter[keep]])
        yield _buckets(points, letter, seen)


def _buckets(points: np.ndarray, letter: np.ndarray, seen: int) -> np.ndarray:
    out = []
    with np.errstate(over="ignore"):
        for n in LENGTHS:
            first = max(0, seen - n + 1)
            p, of = points[first:], letter[first:]
            if len(p) < n:
                continue
            h = np.full(len(p) - n + 1, np.uint64(n))
            for k in range(n):
                h = (h ^ p[k:len(p) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            inner = np.ones(len(h), bool)  # a mark only at either end, and a letter somewhere
            for k in range(1, n - 1):
                inner &= of[k:len(p) - n + 1 + k]
            inner &= of[:len(h)] | of[n - 1:]
            out.append((h[inner] >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def bucket_counts(text: str) -> np.ndarray:
    """How often each bucket occurs in the text."""
    return sum((np.bincount(found, minlength=BUCKETS) for found in subword_blocks(text)), np.zeros(BUCKETS, np.int64))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float
    accept: float

    def logits(self, text: str) -> np.ndarray | None:
        """Class scores before the temperature; None without a letter."""
        total, count = np.zeros(len(self.languages)), 0
        for found in subword_blocks(text):
            total += self.scores[found].sum(axis=0, dtype=np.float64)
            count += len(found)
        return total / count + self.bias if count else None

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        z = self.logits(text) if text else None
        if z is None or not self.languages:
            return UNKNOWN, 0.0, False
        p = softmax(z / self.temperature)
        k = int(p.argmax())
        return self.languages[k], float(p[k]), bool(p[k] >= self.accept)


def train(rows: list[tuple[str, str]], epochs: int = 8, rate: float = 0.5, seed: int = 11,
          reject_share: float = 0.01) -> Model:
    """``rows``: (text, language). Plain SGD over documents in random order, decaying rate."""
    docs = [(found, counts[found], lang) for text, lang in sorted(rows, key=lambda r: (r[1], r[0]))
            if len(found := np.flatnonzero(counts := bucket_counts(text)))]
    languages = sorted({lang for *_, lang in docs})
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(docs))
    held, used = (order[:len(docs) // 5], order[len(docs) // 5:]) if len(docs) >= 20 else (order, order)
    table = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    weight, bias = rng.normal(0, 0.1, (DIM, len(languages))), np.zeros(len(languages))
    place = {lang: k for k, lang in enumerate(languages)}
    packed = [(buckets, counts, place[lang]) for buckets, counts, lang in docs]
    step, steps = 0, epochs * len(used)
    for _ in range(epochs):
        for d in rng.permutation(used):
            buckets, counts, y = packed[d]
            share = counts / counts.sum()
            mean = share @ table[buckets]
            wrong = softmax(mean @ weight + bias)
            wrong[y] -= 1
            eta = rate * (1 - step / steps)
            back = weight @ wrong
            weight -= eta * np.outer(mean, wrong)
            bias -= eta * wrong
            # scaled so that every bucket of the text moves about as far as the mean should
            table[buckets] -= (eta * np.minimum(1.0, share * len(buckets))[:, None] * back[None, :]).astype(np.float32)
            step += 1
    model = Model(languages, (table @ weight).astype(np.float32), bias, 1.0, 0.0)
    logits = np.array([model.scores[packed[d][0]].T @ (packed[d][1] / packed[d][1].sum()) + bias for d in held])
    truth = np.array([packed[d][2] for d in held])
    grid = np.geomspace(0.25, 4.0, 33)
    loss = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    model.accept = float(np.quantile(softmax(logits / model.temperature).max(axis=1), reject_share))
    return model


def fit(docs: DataFrame, use: Column, per_language: int = PER_LANGUAGE, sample_rows: int = SAMPLE_ROWS,
        max_languages: int = MAX_LANGUAGES) -> Model:
    """Train on a bounded sample of the rows of ``docs`` (doc_id, text, lang) where ``use`` holds."""
    known = docs.where(use & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = known.groupBy("lang").count().limit(max_languages + 1).collect()
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} values of lang: no column of languages")
    if not sizes:
        return train([])
    wanted = min(per_language, max(1, sample_rows // len(sizes)))
    shares = docs.sparkSession.createDataFrame(
        [(r["lang"], int(min(1.0, wanted / r["count"]) * (1 << 30))) for r in sizes], "lang string, _share long")
    # at most max_languages rows of a name and a number are broadcast
    chosen = known.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) < F.col("_share"))
    return train([(r.text, r.lang) for r in chosen.select("text", "lang").toLocalIterator()])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) for every row."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([f[2] for f in found], pa.bool_())], names=["doc_id", "lang_pred", "score", "accepted"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, accepted boolean")
