"""Soft-membership mixing: document rates whose expected domain token totals match targets.

A domain is a combination of label values, such as (quality 1, toxic 0).  One sparse logistic model for each label
column, learned from labelled rows over hashed distinct words, gives the probability of the label; a document's
posterior of a domain is the product.  With n_i tokens and posteriors p_ik, rates r_i >= 0 are fitted so that
``sum_i r_i n_i p_ik`` meets the target T_k of every domain, in least squares of relative errors, by projected
gradient descent from r = 1::

    r_i <- max(0, y_i - sum_k p_ik ((A y)_k - T_k) / (A 1)_k)

where y carries r on by its last move (Nesterov's momentum, started anew where the error grows).  The step is safe
at length one: with these weights the quadratic form's matrix has rows that sum to one.  A round is one Spark
job that gives as many sums as there are domains.  A document's rate follows from its posteriors, the rates that were
last written (every ``STORED`` rounds) and the coefficients of the rounds since, so rounds survive lost executors.

It learns from at most ``TRAIN_ROWS`` labelled documents (by a hash of the id); posteriors and sums cover all rows.

Edge cases: a null or empty text has no tokens, the posteriors of the bias, and a rate like other rows.  Very long
texts are one row each.  Repeated rows get equal rates.  Without labels every posterior is that of an even split.
An empty table gives an empty result.  Extra columns are left out.  A domain without tokens cannot be met; its
target is ignored.
"""

from __future__ import annotations

import itertools
import uuid
import warnings
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ecospark.llm.common import arrow_map, documents_of, drop_scratch, materialize, slices, spare_names, worker_cache
from ecospark.llm.hashed_words import CACHE_WORDS, labelled_features, word_hash
from ecospark.llm.toxicity_ftrl import SLOTS, Ftrl, plain_word

#: Labelled documents used for training at most, for each label column.
TRAIN_ROWS = 5000
LEADS = (4, 5, 7)
#: Rounds in which a fit that goes on lowers its error by a tenth.
STILL = 20


def word_slots(word: str) -> list[int]:
    """Slots of the plain word, its leading bytes, and its last two characters as written."""
    data = plain_word(word).encode("utf-8", "surrogatepass")
    size = len(data)
    return [crc32(data[:n], n) % SLOTS for n in LEADS if n < size] + \
        [crc32(data, 61) % SLOTS, crc32(word[-2:].encode("utf-8", "surrogatepass"), 36) % SLOTS]


def shape_slots(words: int, distinct: int) -> list[int]:
    """Slots of a text's length (powers of two) and of its share of distinct words (tenths)."""
    return [word_hash(f"len{words.bit_length()}") % SLOTS, word_hash(f"new{10 * distinct // max(1, words)}") % SLOTS]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The slots of a text, each once, and the number of distinct words that have them."""
    every = text.split()
    words = set(every)
    slots = [s for w in words for s in word_slots(w)] + shape_slots(len(every), len(words))
    return np.unique(np.array(slots, np.int64), return_counts=True)


def train(sample: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 4, seed: int = 9) -> tuple[np.ndarray, np.ndarray, float]:
    """Slots with a weight, their weights, and the bias, from the slots, counts and label of each document."""
    model = Ftrl()
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(sample)):
            at, count, label = sample[k]
            model.learn(at, count.astype(np.float64), int(label > 0))
    weights = model.weights(np.arange(SLOTS))
    at = np.flatnonzero(weights)
    return at, weights[at].astype(np.float32), model.bias()


class Scorer:
    """Probabilities of each label column; made once in each Python worker.  The weights of a word's slots are added
    up once; beyond ``CACHE_WORDS`` words those that were met in one call only are forgotten."""

    def __init__(self, models: list[tuple[np.ndarray, np.ndarray, float]]):
        self.by_slot = np.zeros((SLOTS, len(models)), np.float32)
        for k, (at, w, _) in enumerate(models):
            self.by_slot[at, k] = w
        self.bias = np.array([b for _, _, b in models])
        self.row: dict[str, int] = {}
        self.again: set[str] = set()
        self.values = np.zeros((0, len(models)))

    def _describe(self, words: list[str]) -> np.ndarray:
        """The sum of the weights of ``word_slots`` of each word."""
        data = [plain_word(w).encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, data), np.int64)
        ends = [w[-2:].encode("utf-8", "surrogatepass") for w in words]
        out = self.by_slot[np.array([crc32(d, 61) for d in data], np.int64) % SLOTS].astype(np.float64)
        out += self.by_slot[np.array([crc32(d, 36) for d in ends], np.int64) % SLOTS]
        for n in LEADS:
            longer = np.flatnonzero(size > n)
            out[longer] += self.by_slot[np.array([crc32(data[k][:n], n) for k in longer.tolist()], np.int64) % SLOTS]
        return out

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and, for each text and label column, the probability of label 1."""
        words = [t.split() for t in texts]
        distinct = [set(w) for w in words]
        every = set().union(*distinct)
        if len(self.row) > CACHE_WORDS:
            kept = list(self.again if len(self.again) < CACHE_WORDS // 2 else every & self.again)
            self.values = self.values[np.fromiter(map(self.row.__getitem__, kept), np.int64, len(kept))]
            self.row, self.again = dict(zip(kept, range(len(kept)))), set(kept)
        fresh = list(every.difference(self.row))
        self.again |= every.difference(fresh)
        if fresh:
            self.row.update(zip(fresh, range(len(self.row), len(self.row) + len(fresh))))
            self.values = np.concatenate([self.values, self._describe(fresh)])
        out = np.tile(self.bias, (len(texts), 1))
        for n, (w, d) in enumerate(zip(words, distinct)):
            if d:
                out[n] += self.values[np.fromiter(map(self.row.__getitem__, d), np.int64, len(d))].sum(0)
            out[n] += self.by_slot[shape_slots(len(w), len(d))].sum(0)
        return np.array([len(w) for w in words], np.int64), 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def domains_of(columns: list[str]) -> list[str]:
    """Names of the combinations of label values, in the order of the posteriors: ``quality1_toxic0`` and so on."""
    return ["_".join(f"{c}{v}" for c, v in zip(columns, values)) for values in itertools.product((0, 1), repeat=len(columns))]


def posteriors(docs: DataFrame, labels: DataFrame, columns: list[str], train_rows: int = TRAIN_ROWS, keep=None,
               id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """doc_id, n_tokens and p (an array over ``domains_of(columns)``) of every document; ``keyed`` adds text_key, a
    hash of the text."""
    plain = documents_of(docs, id_col, text_col)
    models = docs.sparkSession.sparkContext.broadcast(
        [train(sample) for sample in labelled_features(plain, labels, columns, train_rows, features, keep)])
    key, combos = uuid.uuid4().hex, list(itertools.product((0, 1), repeat=len(columns)))
    if keyed:
        plain = plain.withColumn("text_key", F.xxhash64("text"))

    def per_batch(batch):
        scorer = worker_cache(key, lambda: Scorer(models.value))
        for part in slices(batch, "text", 1_000_000):  # a worker holds the words of that many bytes as objects
            tokens, one = scorer(part.column("text").to_pylist())
            p = np.stack([np.prod(np.where(np.array(v), one, 1 - one), axis=1) for v in combos], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * len(combos), pa.int32()), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(tokens), lists] + [part.column(c) for c in ["text_key"] * keyed],
                                             ["doc_id", "n_tokens", "p"] + ["text_key"] * keyed)
    return arrow_map(plain, per_batch, "doc_id long, n_tokens long, p array<double>" + ", text_key long" * keyed)


@dataclass
class Fit:
    """Momentum and coefficients of the rounds, and the expected totals before, as wanted, and reached; ``met`` says
    of each domain whether that is within the tolerance."""

    rounds: list[tuple[float, np.ndarray]]
    start: np.ndarray
    target: np.ndarray
    reached: np.ndarray
    met: np.ndarray | None = None

    def rates(self, p: np.ndarray, since: int = 0, r=None, last=None) -> np.ndarray:
        return self.moves(p, since, r, last)[0]

    def moves(self, p: np.ndarray, since: int = 0, r=None, last=None) -> tuple[np.ndarray, np.ndarray]:
        """The rates and those of the round before; ``r`` and ``last`` are those after ``since`` rounds."""
        if r is None:
            r = last = np.ones(len(p))
        for momentum, c in self.rounds[since:]:
            r, last = np.maximum(0.0, r + momentum * (r - last) - p @ c), r
        return r, last


def _matrix(column: pa.ListArray, k: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)


#: Rounds after which rates are stored, so that a round takes up to that many moves a row whatever their number.
STORED = 8


class _Rates:
    """The rows of a fit, with the rates after the rounds that are stored."""

    def __init__(self, members: DataFrame, k: int):
        self.rows, self.k, self.since = members.select("n_tokens", "p"), k, 0

    def _moves(self, fit: Fit, batch: pa.RecordBatch, since: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = _matrix(batch.column("p"), self.k)
        stored = [batch.column(c).to_numpy() for c in ("rate", "last")] if since else [None, None]
        return p, *fit.moves(p, since, *stored)

    def totals(self, rounds: list) -> np.ndarray:
        """Expected tokens of each domain at the rates of the given rounds.  Sums of tasks are added up as decimals,
        whose sum does not depend on their order."""
        fit, since, k = Fit(rounds, None, None, None), self.since, self.k

        def run(batches):
            total = np.zeros(k)
            for batch in batches:
                p, rate, _ = self._moves(fit, batch, since)
                total += (rate * batch.column("n_tokens").to_numpy().astype(np.float64)) @ p
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], [f"t{c}" for c in range(k)])
        parts = self.rows.mapInArrow(run, ", ".join(f"t{c} double" for c in range(k)))
        found = parts.agg(*[F.sum(F.col(f"t{c}").cast("decimal(38,9)")).alias(f"t{c}") for c in range(k)]).first()
        return np.array([float(x or 0) for x in found])

    def store(self, rounds: list) -> None:
        fit, since = Fit(list(rounds), None, None, None), self.since

        def per_batch(batch):
            _, rate, last = self._moves(fit, batch, since)
            yield pa.RecordBatch.from_arrays([batch.column("n_tokens"), batch.column("p"), pa.array(rate), pa.array(last)],
                                             ["n_tokens", "p", "rate", "last"])
        after = materialize(arrow_map(self.rows, per_batch, "n_tokens long, p array<double>, rate double, last double"), "rates")
        self.drop()
        self.rows, self.since = after, len(rounds)

    def drop(self) -> None:
        if self.since:
            drop_scratch(self.rows)

    def __reduce__(self):  # tasks need the number of domains only
        return _Rates._of, (self.k,)

    @classmethod
    def _of(cls, k: int) -> _Rates:
        out = cls.__new__(cls)
        out.k = k
        return out


def fit_rates(members: DataFrame, k: int, weights: np.ndarray | None = None, factors: np.ndarray | None = None,
              rounds: int | None = None, tolerance: float = 1e-3) -> Fit:
    """Fit rates to targets: ``weights`` are shares of all tokens (they are normalised), ``factors`` multiply each
    domain's present total.  Ends when every domain is within ``tolerance`` of its target (for a target of zero,
    within ten times the tolerance of its present total), when ``STILL`` rounds lower the error by less than a tenth,
    or after ``rounds`` if given."""
    rates = _Rates(members, k)
    start = rates.totals([])
    target = start * factors if factors is not None else start.sum() * np.asarray(weights, float) / np.sum(weights)
    scale = np.maximum(start, 1e-9)
    done: list[tuple[float, np.ndarray]] = []
    reached = before = start
    error, age, errors = np.inf, 0, []
    while True:
        gap = np.where(start > 0, reached - target, 0.0)
        met = np.abs(gap) <= tolerance * np.maximum(np.where(target > 0, target, 10 * start), 1.0)
        now = float((gap * gap / scale).sum())
        errors.append(now)
        still = len(errors) > STILL and min(errors[-STILL:]) > 0.9 * min(errors[:-STILL])
        if met.all() or still or len(done) == rounds:
            break
        age = age + 1 if now < error else 0
        error, momentum = now, max(0.0, (age - 1) / (age + 2))
        ahead = gap + momentum * np.where(start > 0, reached - before, 0.0)
        done.append((momentum, ahead / scale))
        if len(done) % STORED == 0:
            rates.store(done)
        before, reached = reached, rates.totals(done)
    rates.drop()
    return Fit(done, start, target, reached, met)


def with_rates(members: DataFrame, k: int, fit: Fit) -> DataFrame:
    """``members`` with rate and copies: the rate rounded by a hash of the id so that its mean is the rate.  Where
    there is no id, text_key serves."""
    def per_batch(batch):
        rates = fit.rates(_matrix(batch.column("p"), k))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates)], [*batch.schema.names, "rate"])
    out = arrow_map(members, per_batch, StructType([*members.schema.fields, StructField("rate", DoubleType())]))
    by = F.coalesce("doc_id", "text_key") if "text_key" in members.columns else F.col("doc_id")
    chance = F.pmod(F.xxhash64(by, F.lit(17)), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return out.withColumn("copies", F.floor(F.col("rate") + chance).cast("int"))


def mix(docs: DataFrame, labels: DataFrame, columns: list[str], weights: dict[str, float] | None = None,
        factors: dict[str, float] | None = None, rounds: int | None = None, **settings) -> tuple[DataFrame, Fit]:
    """Rates of every document (doc_id, n_tokens, p, rate, copies) and the fit.  Domains without a weight get none;
    domains without a factor stay as they are."""
    names = domains_of(columns)
    members = materialize(posteriors(docs, labels, columns, **settings), "memberships")
    fit = fit_rates(members, len(names), None if weights is None else np.array([weights.get(n, 0.0) for n in names]),
                    None if weights is not None else np.array([(factors or {}).get(n, 1.0) for n in names]), rounds)
    return with_rates(members, len(names), fit), fit


def keep_mixed(docs: DataFrame, labels: DataFrame, columns: list[str], factors: dict[str, float],
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, each as often as its copies say: not at all, once, or repeatedly.  Rows with
    the same id and different texts have copies of their own."""
    rates, fit = mix(docs, labels, columns, factors=factors, id_col=id_col, text_col=text_col, keyed=True)
    for name, target, reached, met in zip(domains_of(columns), fit.target, fit.reached, fit.met):
        if not met:
            warnings.warn(f"{name}: {reached:.0f} expected tokens, target {target:.0f}")
    of, key, n, nth = spare_names(docs, 4)
    copies = rates.groupBy(F.col("doc_id").alias(of), F.col("text_key").alias(key)).agg(F.max("copies").alias(n))
    copies = materialize(copies.where(F.col(n) > 0), "copies")
    mine = F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    out = docs.join(copies, F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(of)) & (mine == F.col(key)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col(n))).alias(nth)).drop(nth)
