"""Words as rows of a table that grows as they are met: what depends on a word alone is computed once a worker."""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import arrow_map, drop_scratch, materialize, slices

#: Words remembered in one Python worker; beyond it the table is started anew.
CACHE_WORDS = 300_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_hash(word: str) -> int:
    """32 bits of a word that are the same on every machine."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass"))


def pair_slots(left: np.ndarray, right: np.ndarray, salt: int, slots: int) -> np.ndarray:
    """Slots of pairs of word hashes (uint64 arrays); ``salt`` sets kinds of pairs apart."""
    with np.errstate(over="ignore"):
        x = (left * _MIX) ^ (right + np.uint64(salt)) * np.uint64(0xC2B2AE3D27D4EB4F)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(33)) % np.uint64(slots)


class WordTable(dict):
    """Row numbers of words; ``describe(word)`` gives a row of numbers, the last being the word's hash."""

    def __init__(self, describe):
        self.describe, self.fresh = describe, []
        self.values = self.hashes = None

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.fresh.append(self.describe(word))
        return n

    def rows(self, texts: list[str]) -> list[np.ndarray]:
        """For each text, the rows of its words in order.  Rows of earlier calls may be gone afterwards."""
        if len(self) > CACHE_WORDS:
            self.clear()
            self.values = self.hashes = None
        lists = [[self[w] for w in t.split()] for t in texts]
        if self.fresh:
            values = np.array([r[:-1] for r in self.fresh], np.float64)
            hashes = np.array([r[-1] for r in self.fresh], np.uint64)
            self.values = values if self.values is None else np.concatenate([self.values, values])
            self.hashes = hashes if self.hashes is None else np.concatenate([self.hashes, hashes])
            self.fresh = []
        return [np.array(x, np.int64) for x in lists]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int, keep=None) -> list[tuple[str, int]]:
    """(text, label) of at most ``bound`` labelled documents: those with the smallest hash of their id, in that
    order.  ``keep`` is a condition on doc_id.  Null labels are left out; ``docs`` has doc_id and text."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    if keep is not None:
        known = known.where(keep)
    known = known.join(docs.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64("doc_id", F.lit(11))
    chosen = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(order, "doc_id").limit(bound)
    rows = chosen.join(docs, "doc_id").select("doc_id", "label", "text").collect()
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (word_hash(str(r["doc_id"])), r["doc_id"], r["text"]))]


def labelled_features(docs: DataFrame, labels: DataFrame, columns: list[str], bound: int, describe, keep=None
                      ) -> list[list[tuple[np.ndarray, np.ndarray, int]]]:
    """For each label column, (slots, counts, label) of at most ``bound`` labelled documents: those with the smallest
    hash of their id.  ``describe(text)`` gives the slots, each once, and their counts.

    Tasks turn the texts into slots and counts, so the driver sees no text; it takes them in task by task.  Labels and
    texts are read once for all columns.  ``keep`` is a condition on doc_id; null labels are left out."""
    names = [f"label_{k}" for k in range(len(columns))]
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          *[F.col(f"`{c}`").cast("int").alias(n) for c, n in zip(columns, names)]).where(F.coalesce(*names).isNotNull())
    if keep is not None:
        known = known.where(keep)
    known = materialize(known.join(docs.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id")
                        .agg(*[F.max(n).alias(n) for n in names]), "labelled")
    order = F.xxhash64("doc_id", F.lit(11))
    best = [known.where(F.col(n).isNotNull()).orderBy(order, "doc_id").limit(bound).select(
        "doc_id", *[(F.col(m) if m == n else F.lit(None).cast("int")).alias(m) for m in names]) for n in names]
    chosen = reduce(DataFrame.unionByName, best).groupBy("doc_id").agg(*[F.max(n).alias(n) for n in names])

    def per_batch(batch):
        for part in slices(batch, "text", 1_000_000):
            found = [describe(t) for t in part.column("text").to_pylist()]
            data = [[a.astype("<u4").tobytes() for a, _ in found],
                    [n.astype("<u2" if n.max(initial=0) < 1 << 16 else "<u4").tobytes() for _, n in found]]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", *names)), *(pa.array(d, pa.binary()) for d in data)],
                                             ["doc_id", *names, "slots", "counts"])
    schema = "doc_id long, " + ", ".join(f"{n} int" for n in names) + ", slots binary, counts binary"
    table = materialize(arrow_map(chosen.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", *names, "text"), per_batch, schema), "labelled-slots")
    rows = []
    for r in table.toLocalIterator():
        at = np.frombuffer(r["slots"], "<u4")
        count = np.frombuffer(r["counts"], f"<u{len(r['counts']) // len(at)}") if len(at) else np.zeros(0, np.uint16)
        rows.append((word_hash(str(r["doc_id"])), r["doc_id"], at, count, [r[n] for n in names]))
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    drop_scratch(known)
    drop_scratch(table)
    return [[(at, count, label[k]) for _, _, at, count, label in rows if label[k] is not None] for k in range(len(names))]


def remainder(column: str, base: int):
    """crc32 of the decimal text of a number, modulo ``base``."""
    return F.pmod(F.crc32(F.encode(F.col(column).cast("string"), "utf-8")), F.lit(base))
