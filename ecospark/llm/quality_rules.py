"""Quality rules judged by an isolation forest.

Every whole text gets rule statistics: words, their characters, symbol characters, repeated lines, words in
repeated three-word windows, and ratios made of them.  An isolation forest of random axis splits is grown on a
bounded sample of documents; rare combinations of statistics end in short paths.  The anomaly score
``2 ** (-mean path / expected path)`` of every document is then compared with a threshold that is calibrated on all
labelled rows: the lowest at which at most ``false_share`` of the good documents score higher, chosen to separate
the labels best.

The sample's bound (``trees * leaf_sample`` rows, by a hash of the document id) is a parameter of the forest; the
statistics, the scores and the calibration cover all rows.

Edge cases: a null text is an empty text: no words, all counts 0, rejected by the base rules.  Very long texts are
one row each.  Repeated rows get equal results; ties at the threshold are kept.  Without labels, or with one class
only, the threshold is infinite and the base rules alone decide.  An empty table gives an empty result.  Extra
columns are left out.  Null labels are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import arrow_map, documents_of, materialize, slices

_SYMBOL = re.compile(r"[#*$%&|<>]")
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_upper",
          "n_marks", "n_distinct", "n_same_next"]
FEATURES = ["mean_word", "symbols", "dup_lines", "repeat_words", "upper", "marks", "distinct", "same_next", "log_words"]


class _Ids(dict):
    """Numbers words in order of appearance."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


def repeated_words(ids: np.ndarray, width: int = 3) -> int:
    """Words that lie in a window of ``width`` words which occurs at least twice, all occurrences included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key, base = ids[:n].astype(np.int64), int(ids.max()) + 1
    for k in range(1, width):
        if base ** (k + 1) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key * base + ids[k:n + k]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(width):
        covered[k:n + k] |= twice
    return int(covered.sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The values of ``COUNTS`` of one text."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes are cut at the six ASCII spaces only
    lines = [x for x in data.split(b"\n") if x.strip()]
    numbers = _Ids()
    ids = np.fromiter((numbers[w] for w in words), np.int64, len(words))
    upper = sum(map(str.isupper, text)) if any(map(str.isupper, text)) else 0
    return (len(words), len(text) - sum(map(text.count, " \t\n\v\f\r")), len(_SYMBOL.findall(text)), len(lines) - len(set(lines)),
            repeated_words(ids), len(text), len(lines), upper, text.count("!") + text.count("?"), len(numbers),
            int((ids[1:] == ids[:-1]).sum()))


def rule_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of every whole text (all long)."""
    def per_batch(batch):
        for part in slices(batch, "text"):
            rows = [text_counts(t) for t in part.column("text").to_pylist()]
            columns = np.array(rows, np.int64).reshape(len(rows), len(COUNTS)).T
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c) for c in columns)], ["doc_id", *COUNTS])
    return arrow_map(documents_of(docs, id_col, text_col), per_batch,
                     "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def features(frame: pd.DataFrame) -> np.ndarray:
    """Scale-free statistics, one row a document, in the order of ``FEATURES``."""
    c = {k: frame[k].to_numpy(np.float64) for k in COUNTS}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "n_chars", "n_lines"))
    return np.stack([c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines, c["n_repeat_words"] / words,
                     c["n_upper"] / chars, c["n_marks"] / chars, c["n_distinct"] / words, c["n_same_next"] / words,
                     np.log1p(c["n_words"])], axis=1)


@dataclass
class Forest:
    """Trees in arrays [tree, node]: split feature (-1: leaf), split value, path length of a leaf.  The children of
    node i are 2i+1 and 2i+2."""

    feature: np.ndarray
    value: np.ndarray
    length: np.ndarray
    expected: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, length in zip(self.feature, self.value, self.length):
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= value[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += length[node]
        return np.exp2(-total / max(1, len(self.feature)) / self.expected)


def _expected(n: float) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 1.0 if n < 3 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


def grow(x: np.ndarray, trees: int, leaf_sample: int, seed: int) -> Forest:
    """Random splits until rows are alone or the depth of a balanced tree is reached."""
    rng = np.random.default_rng(seed)
    size = min(leaf_sample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, size)))))
    nodes = 2 ** (depth + 1) - 1
    feature, value, length = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        work = [(0, 0, x[rng.choice(len(x), size, replace=False)])] if size else []
        while work:
            node, level, part = work.pop()
            low, high = (part.min(0), part.max(0)) if len(part) else (0, 0)
            free = np.flatnonzero(np.asarray(high) > np.asarray(low))
            if level == depth or len(part) < 2 or not len(free):
                length[t, node] = level + _expected(len(part))
                continue
            f = rng.choice(free)
            v = rng.uniform(low[f], high[f])
            v = v if v > low[f] else high[f]
            feature[t, node], value[t, node] = f, v
            right = part[:, f] >= v
            work += [(2 * node + 1, level + 1, part[~right]), (2 * node + 2, level + 1, part[right])]
    return Forest(feature, value, length, max(_expected(size), 1e-9))


#: Scores are compared on this grid, so that the calibration is a count of bounded size.
BINS = 2000


def judge(stats: DataFrame, labels: DataFrame | None, trees: int = 128, leaf_sample: int = 256,
          false_share: float = 0.01, seed: int = 7) -> DataFrame:
    """``stats`` plus anomaly (double, on a grid of 1/BINS), threshold and unusual (anomaly above the threshold)."""
    spark = stats.sparkSession
    bound = trees * leaf_sample
    n = stats.count()
    step = max(1, n // bound)
    sample = stats.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(step)) == 0).select("doc_id", *COUNTS) \
        .orderBy(F.xxhash64("doc_id", F.lit(seed)), *COUNTS).limit(bound).toPandas()
    forest = spark.sparkContext.broadcast(grow(features(sample), trees, leaf_sample, seed))

    def score(frames):
        for frame in frames:
            out = np.round(forest.value.score(features(frame)) * BINS) / BINS
            yield frame.assign(anomaly=out)

    scored = materialize(stats.mapInPandas(score, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", anomaly double"),
                         "rule-scores")
    threshold = float("inf")
    if labels is not None:
        known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).alias("good")).dropna()
        counts = scored.select("doc_id", "anomaly").join(known, "doc_id").groupBy("anomaly", "good").count().collect()
        threshold = calibrate([(r["anomaly"], r["good"], r["count"]) for r in counts], false_share)
    return scored.withColumn("threshold", F.lit(threshold)).withColumn("unusual", F.col("anomaly") > F.lit(threshold))


def calibrate(counts: list[tuple[float, bool, int]], false_share: float) -> float:
    """The threshold that separates the labels best (share of bad rows above it less that of good rows) among those
    with at most ``false_share`` of the good rows above; infinite if it finds no bad row."""
    good, bad = (sum(n for _, g, n in counts if g is k) for k in (True, False))
    best, found = float("inf"), 0.0
    if not good or not bad:
        return best
    above = {True: 0, False: 0}
    for value in sorted({v for v, _, _ in counts}, reverse=True):
        share = above[False] / bad - above[True] / good
        if above[True] <= false_share * good and share > found:
            best, found = value, share
        for v, g, n in counts:
            if v == value:
                above[g] += n
    return best


def apply_rules(docs: DataFrame, labels: DataFrame | None, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """doc_id, the counts, base_failed, anomaly, threshold and kept of every document."""
    judged = judge(materialize(rule_stats(docs, id_col, text_col), "rule-stats"), labels, **settings)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~F.col("unusual")).drop("unusual")
