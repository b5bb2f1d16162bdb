"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are hashed: each distinct word with its leading letter groups, each distinct pair of
neighbouring words, and each distinct pair with one word skipped.  Words are lower-cased and freed of marks at
their ends.  A feature's value is the number of distinct grams that share its slot.  FTRL-proximal gives every
coordinate a rate of its own and L1 sparsity, so that few weights remain; those are broadcast.

It learns from a bounded sample of labelled documents (``TRAIN_ROWS``, by a hash of the id); every whole text is
scored.

Edge cases: a null or empty text has no grams and gets the bias.  Very long texts are one row each.  Repeated rows
get equal scores.  Without labels the score is 0.5; with one class the bias stands for it.  An empty table gives an
empty result.  Extra columns are left out.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ecospark.llm.common import arrow_map, documents_of, slices, worker_cache
from ecospark.llm.hashed_words import WordTable, labelled_sample, pair_slots, word_hash

#: Labelled documents used for training at most.
TRAIN_ROWS = 8000
SLOTS = 1 << 20
#: Lengths of the leading letter groups of a word that are features beside the word.
LEADS = (3, 4, 5, 6, 7, 8)
_EDGES = ".,;:!?*%&$#|<>()[]{}\"'"


def plain_word(word: str) -> str:
    return word.lower().strip(_EDGES)


def word_slots(word: str) -> list[int]:
    w = plain_word(word)
    return [word_hash(f"{n}:{w[:n]}") % SLOTS for n in LEADS if n < len(w)] + [word_hash("=" + w) % SLOTS]


def pair_features(hashes: np.ndarray) -> np.ndarray:
    """Distinct slots of neighbouring words and of words with one between them."""
    near = pair_slots(hashes[:-1], hashes[1:], 1, SLOTS)
    skip = pair_slots(hashes[:-2], hashes[2:], 2, SLOTS)
    return np.concatenate([np.unique(near), np.unique(skip)]).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-proximal state; weights are derived from it and are zero within the L1 bound."""

    def __init__(self, alpha: float = 0.3, beta: float = 1.0, l1: float = 4.0, l2: float = 0.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)  # the last coordinate is the bias, without L1

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def bias(self) -> float:
        return float(-self.z[-1] / ((self.beta + np.sqrt(self.n[-1])) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.bias()
        p = 1 / (1 + np.exp(-np.clip(w @ value + b, -30, 30)))
        g = (p - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g
        g = p - label
        self.z[-1] += g - (np.sqrt(self.n[-1] + g * g) - np.sqrt(self.n[-1])) / self.alpha * b
        self.n[-1] += g * g


def train(sample: list[tuple[str, int]], epochs: int = 5, seed: int = 3, **settings) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots with a weight, their weights, and the bias."""
    model, rows, known = Ftrl(**settings), [], {}
    for text, label in sample:
        words = text.split()
        for w in words:
            if w not in known:
                known[w] = word_hash(plain_word(w)), word_slots(w)
        every = [s for w in {plain_word(w): w for w in words}.values() for s in known[w][1]]
        hashes = np.array([known[w][0] for w in words], np.uint64)
        at, count = np.unique(np.concatenate([np.array(every, np.int64), pair_features(hashes)]), return_counts=True)
        rows.append((at.astype(np.int32), np.minimum(count, 255).astype(np.uint8), int(label > 0)))
        if len(known) > 500_000:
            known.clear()
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, value, label = rows[k]
            model.learn(at, value.astype(np.float64), label)
    weights = model.weights(np.arange(SLOTS))
    at = np.flatnonzero(weights)
    return at.astype(np.int64), weights[at].astype(np.float32), model.bias()


class Scorer:
    """Scores texts with the sparse weights; made once in each Python worker."""

    def __init__(self, at: np.ndarray, weights: np.ndarray, bias: float):
        self.weights, self.bias = np.zeros(SLOTS, np.float32), bias
        self.weights[at] = weights
        self.by_slot = dict(zip(at.tolist(), weights.tolist()))
        self.table = WordTable(self._describe)

    def _describe(self, word: str) -> tuple[float, int]:
        get = self.by_slot.get
        return sum([get(s, 0.0) for s in word_slots(word)]), word_hash(plain_word(word))

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.empty(len(texts))
        for n, at in enumerate(self.table.rows(texts)):
            total = self.bias
            if len(at):
                hashes = self.table.hashes[at]
                values = self.table.values[at, 0]
                weighty = np.flatnonzero(values)
                if len(weighty):  # distinct words only
                    first = np.unique(hashes[weighty], return_index=True)[1]
                    total += float(values[weighty[first]].sum())
                for a, b, salt in ((hashes[:-1], hashes[1:], 1), (hashes[:-2], hashes[2:], 2)):
                    slots = pair_slots(a, b, salt, SLOTS).astype(np.int64)
                    slots = slots[self.weights[slots] != 0]
                    if len(slots):
                        total += float(self.weights[np.unique(slots)].sum(dtype=np.float64))
            out[n] = total
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def score_documents(docs: DataFrame, labels: DataFrame, keep=None, label: str = "toxic", train_rows: int = TRAIN_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document; ``keep`` is a condition on doc_id for rows that may be learned from."""
    plain = documents_of(docs, id_col, text_col)
    weights = docs.sparkSession.sparkContext.broadcast(train(labelled_sample(plain, labels, label, train_rows, keep)))
    key = uuid.uuid4().hex

    def per_batch(batch):
        scorer = worker_cache(key, lambda: Scorer(*weights.value))
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scorer(part.column("text").to_pylist()))],
                                             ["doc_id", "score"])
    return arrow_map(plain, per_batch, "doc_id long, score double")
