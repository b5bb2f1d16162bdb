"""Quality classifier of supervised subword embeddings.

A document is the mean of learned vectors: one for each hashed word, character n-gram of a word, and pair of
neighbouring words (a word followed by itself has a slot of its own).  A softmax layer on the mean gives the class
probabilities.  Vectors and layer are trained together by stochastic gradient descent in numpy on a bounded sample
of labelled documents (``TRAIN_ROWS``, by a hash of the id); tasks turn their texts into slots and counts.

With the layer known, a vector matters only by its part in the difference of the two outputs, so scoring broadcasts
one number a slot and adds them up; words are looked up once a worker.

Edge cases: a null or empty text has no words and gets the share that the layer's bias stands for.  Very long texts
are one row each, read whole.  Repeated rows get equal scores.  Without labels of both classes the score is the
share of the only class, 0.5 with no labels.  An empty table gives an empty result.  Extra columns are left out.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ecospark.llm.common import arrow_map, documents_of, slices, worker_cache
from ecospark.llm.hashed_words import WordTable, labelled_features, pair_slots, word_hash

#: Labelled documents used for training at most.
TRAIN_ROWS = 5000
SLOTS, DIM, GRAMS = 1 << 16, 12, (2, 3)
_TWICE = word_hash("\0twice") % SLOTS


def word_slots(word: str) -> list[int]:
    """Slots of a word and of its character n-grams, whose first and last carry a boundary mark."""
    marked = f"<{word}>"
    data = [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    return [word_hash(g) % SLOTS for g in data] + [word_hash("\1" + word) % SLOTS]


@dataclass
class Model:
    """Vectors [slot, DIM], layer [2, DIM] and bias [2]."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def compact(self) -> tuple[np.ndarray, float]:
        """What a slot and the bias add to the difference of the outputs of class 1 and class 0."""
        return (self.vectors @ (self.layer[1] - self.layer[0])).astype(np.float32), float(self.bias[1] - self.bias[0])


def _pairs(hashes: np.ndarray) -> np.ndarray:
    slots = pair_slots(hashes[:-1], hashes[1:], 1, SLOTS).astype(np.int64)
    return np.where(hashes[:-1] == hashes[1:], _TWICE, slots)


#: Words whose slots are held at once.
WORDS_HELD = 50_000


@lru_cache(maxsize=WORDS_HELD)
def _slots(word: str) -> np.ndarray:
    return np.array(word_slots(word), np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The slots of a text, each once, and how often it has them; long texts are counted in parts."""
    words = text.split()
    total = np.zeros(SLOTS, np.int64)
    for at in range(0, len(words), WORDS_HELD):
        part = words[at:at + WORDS_HELD + 1]  # with the word that the last pair ends in
        pairs = _pairs(np.array([word_hash(w) for w in part], np.uint64))
        total += np.bincount(np.concatenate([*map(_slots, part[:WORDS_HELD]), pairs]), minlength=SLOTS)
    place = np.flatnonzero(total)
    return place, total[place]


def train(sample: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 6, rate: float = 0.5, seed: int = 5) -> Model:
    """``sample`` has the slots, counts and label of each document."""
    rng = np.random.default_rng(seed)
    model = Model(rng.uniform(-1, 1, (SLOTS, DIM)) / DIM, np.zeros((2, DIM)), np.zeros(2))
    share = float(np.mean([y > 0 for _, _, y in sample])) if sample else 0.5
    model.bias[1] = np.log((share + 1e-3) / (1 - share + 1e-3))
    if not 0 < share < 1:
        return model
    rows = [(place, count, int(label > 0)) for place, count, label in sample if len(place)]
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            place, count, label = rows[k]
            part = (count / count.sum()).astype(np.float32)
            pace = rate * (1 - done / steps)
            done += 1
            vectors = model.vectors[place]
            mean = part @ vectors
            out = model.layer @ mean + model.bias
            p = np.exp(out - out.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ model.layer
            model.layer -= pace * np.outer(p, mean)
            model.bias -= pace * 0.1 * p
            # a slot's share of a document is tiny: the step is scaled by the slots that share it, as in averaging
            model.vectors[place] -= (pace * 20) * part[:, None] * back[None, :]
    return model


class Scorer:
    """Scores texts with the compact weights; made once in each Python worker."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.table = WordTable(self._describe)

    def _describe(self, word: str) -> tuple[float, int, int]:
        slots = word_slots(word)
        return float(self.weights[slots].sum()), len(slots), word_hash(word)

    def __call__(self, texts: list[str]) -> np.ndarray:
        rows = self.table.rows(texts)
        out = np.empty(len(texts))
        for n, at in enumerate(rows):
            if not len(at):
                out[n] = self.bias
                continue
            values = self.table.values[at].sum(0)
            pairs = self.weights[_pairs(self.table.hashes[at])]
            out[n] = (values[0] + pairs.sum(dtype=np.float64)) / (values[1] + len(pairs)) + self.bias
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _scoring(plain: DataFrame, labels: DataFrame, keep, label: str, train_rows: int):
    """A function from texts to scores, for use in tasks."""
    weights = plain.sparkSession.sparkContext.broadcast(
        train(*labelled_features(plain, labels, [label], train_rows, features, keep)).compact())
    key = uuid.uuid4().hex

    def score(texts: list[str]) -> np.ndarray:
        scorer = worker_cache(key, lambda: Scorer(*weights.value))
        return scorer(texts)
    return score


def score_documents(docs: DataFrame, labels: DataFrame, keep=None, label: str = "quality", train_rows: int = TRAIN_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document; ``keep`` is a condition on doc_id for rows that may be learned from."""
    plain = documents_of(docs, id_col, text_col)
    score = _scoring(plain, labels, keep, label, train_rows)

    def per_batch(batch):
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score(part.column("text").to_pylist()))],
                                             ["doc_id", "score"])
    return arrow_map(plain, per_batch, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, label: str = "quality",
              train_rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""
    score = _scoring(documents_of(docs, id_col, text_col), labels, None, label, train_rows)
    place = docs.columns.index(text_col)

    def per_batch(batch):
        for part in slices(batch, place):
            texts = [t or "" for t in part.column(place).to_pylist()]
            yield part.filter(pa.array(score(texts) >= threshold))
    return arrow_map(docs, per_batch, docs.schema)
