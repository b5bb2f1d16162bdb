"""Exact top-k search with a bit-sliced index.

Every component of a vector is an integer, kept as bit slices: one bitmap for each binary digit of the component's
distance from the smallest value, a bit for each row of a block.  The inner product with a query is a sum of slices
shifted by the digits of the query's components, added with bitmap arithmetic (full adders on whole bitmaps);
a negative component adds the complements.  The best rows are then read from the most significant slice of the sum
downward: rows with the bit come first as long as they are not too many, and the rows tied at the boundary are
resolved by the smaller id.  Scores are read off the slices.

Rows are numbered and cut into blocks of ``BLOCK`` rows; queries are cut into packs of ``PACK``.  Packs are copied for
every block, and a block's slices are made once for all packs that follow it.  A block's best rows for a query are
merged with those of the other blocks by rank.

Edge cases: vectors that are null or hold a null or a non-finite component take no part; an empty vector neither.  A
component beyond ``LIMIT`` after quantisation, or a score that does not fit a long, is an error.  A query is compared with vectors of its own length.  Its own
row is left out by position, so other rows with the same id or vector count, and rows that share an id are queries of
their own.  Ties go to the smaller id.  A null id
is no query and sorts last.  Fewer than k rows give fewer ranks.  An empty table gives an empty result.  Extra
columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import materialize, partitions_for

BLOCK, PACK, SCALE = 49_152, 64, 256
#: Greatest magnitude of a quantised component; differences of two stay within 64 bits.
LIMIT = 1 << 62
_LAST_ID = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and v, the components as integers, of the vectors that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    v = F.transform(x, lambda e: F.when(F.abs(e) * SCALE < float(LIMIT), F.floor(e * SCALE)).otherwise(
        F.raise_error(F.lit(f"a component beyond {LIMIT // SCALE}")).cast("long")))
    sound = F.forall(x, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)))  # NaN is greater than any number
    return vectors.where(sound & (F.size(x) > 0)).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder, with a gapless ``row`` from 0."""
    rows = materialize(df.withColumn("_at", F.monotonically_increasing_id()), name).withColumn("_task", F.shiftright("_at", 33))
    runs = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).selectExpr(
        "_task", "coalesce(sum(n) OVER (ORDER BY _task ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS _before")
    return rows.join(runs, "_task").withColumn("row", F.col("_at") - F.shiftleft(F.col("_task"), 33) + F.col("_before")) \
        .drop("_at", "_task", "_before")


class Index:
    """The bit slices of the rows of a block: ``slices[d][s]`` is the bitmap of digit s of component d."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, values: np.ndarray):
        self.ids, self.rows, self.count = ids, rows, len(ids)
        self.low = values.min(0).astype(np.int64)
        shifted = (values - self.low).astype(np.uint64)
        self.digits = max(1, int(shifted.max()).bit_length())
        self.words = -(-self.count // 64)
        self.slices = np.empty((values.shape[1], self.digits, self.words), np.uint64)
        for s in range(self.digits):
            self.slices[:, s] = self._bitmap((shifted >> np.uint64(s) & np.uint64(1)).T)
        self.every = self._bitmap(np.ones((1, self.count), np.uint32))[0]

    def _bitmap(self, bits: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(bits), self.words * 64), np.uint8)
        padded[:, :self.count] = bits
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def product(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the inner products of all rows with a query, less a constant."""
        constant = sum(a * b for a, b in zip(query.tolist(), self.low.tolist()))
        full = (1 << self.digits) - 1
        open_: list[list[np.ndarray]] = [[] for _ in range(160)]
        for d in np.flatnonzero(query):
            q = int(query[d])
            slices = self.slices[d]
            if q < 0:  # -q * w = |q| * (full - w) - |q| * full
                constant += q * full
                slices = ~slices
                q = -q
            for shift in range(q.bit_length()):
                if q >> shift & 1:
                    for s in range(self.digits):
                        _add(open_, shift + s, slices[s])
        total = []
        for w in range(len(open_)):
            while len(open_[w]) > 1:  # half adder
                a, b = open_[w].pop(), open_[w].pop()
                open_[w].append(a ^ b)
                _add(open_, w + 1, a & b)
            total.append(open_[w][0] if open_[w] else None)
            if not any(open_[w + 1:]):
                break
        zero = np.zeros(self.words, np.uint64)
        return [zero if t is None else t for t in total], constant

    def best(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best rows other than row ``own``, best first."""
        total, constant = self.product(query)
        tied = self.every.copy()
        at = np.flatnonzero(self.rows == own)
        if len(at):
            tied[at[0] // 64] &= ~(np.uint64(1) << np.uint64(at[0] % 64))
        sure, have = np.zeros(self.words, np.uint64), 0
        for slice_ in reversed(total):
            ahead = tied & slice_
            n = int(np.bitwise_count(ahead).sum())
            if have + n > k:
                tied = ahead
            else:
                sure, have = sure | ahead, have + n
                tied = tied & ~slice_
                if have == k:
                    tied = np.zeros_like(tied)
                    break
        chosen = self.positions(sure)
        boundary = self.positions(tied)
        boundary = boundary[np.argsort(self.ids[boundary], kind="stable")[:k - have]]
        rows = np.concatenate([chosen, boundary])
        score = [sum((int(t[r // 64]) >> (r % 64) & 1) << w for w, t in enumerate(total)) + constant for r in rows.tolist()]
        return sorted(zip(self.ids[rows].tolist(), score), key=lambda x: (-x[1], x[0]))


def _add(open_: list[list[np.ndarray]], weight: int, bitmap: np.ndarray) -> None:
    """Add a bitmap at a binary weight; three of a weight become one there and a carry (full adder)."""
    while True:
        waiting = open_[weight]
        if len(waiting) < 2:
            waiting.append(bitmap)
            return
        a, b = waiting.pop(), waiting.pop()
        half = a ^ b
        waiting.append(half ^ bitmap)
        half &= bitmap
        a = a & b
        a |= half
        bitmap, weight = a, weight + 1


def _packed(frame: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    frame = frame.combine_chunks()
    ids = frame["vec_id"].fill_null(_LAST_ID).to_numpy()
    values = frame["v"].combine_chunks().flatten().to_numpy().reshape(-1, dim) if frame.num_rows else np.zeros((0, dim), np.int64)
    return ids, frame["row"].to_numpy(), values


def top_k(vectors: DataFrame, queries, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query.  ``queries`` is a condition on ``vec_id``."""
    rows = materialize(numbered(quantised(vectors, id_col, vector_col), "vectors"), "vectors-numbered") \
        .withColumn("dim", F.size("v")).withColumn("block", F.floor(F.col("row") / BLOCK))
    chosen = materialize(numbered(rows.where(queries & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").alias("query_id"), F.col("row").alias("own"), "v", "dim"), "queries"), "queries-numbered") \
        .withColumn("pack", F.floor(F.col("row") / PACK))

    def pack_rows(key, frame):
        ids, at, values = _packed(frame, key[0].as_py())
        return pa.table({"dim": [key[0].as_py()], "block": [key[1].as_py()], "ids": [ids.astype("<i8").tobytes()],
                         "rows": [at.astype("<i8").tobytes()], "vals": [values.astype("<i8").tobytes()]},
                        schema=pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()),
                                          ("vals", pa.binary())]))

    blocks = materialize(rows.select("dim", "block", "vec_id", "row", "v").groupBy("dim", "block").applyInArrow(
        pack_rows, "dim int, block long, ids binary, rows binary, vals binary"), "blocks")

    def pack_queries(key, frame):
        frame = frame.combine_chunks()
        return pa.table({"dim": [key[0].as_py()], "pack": [key[1].as_py()],
                         "qids": [frame["query_id"].to_numpy().astype("<i8").tobytes()],
                         "own": [frame["own"].to_numpy().astype("<i8").tobytes()],
                         "qvals": [frame["v"].combine_chunks().flatten().to_numpy().astype("<i8").tobytes()]},
                        schema=pa.schema([("dim", pa.int32()), ("pack", pa.int64()), ("qids", pa.binary()), ("own", pa.binary()),
                                          ("qvals", pa.binary())]))

    packs = materialize(chosen.select("dim", "pack", "query_id", "own", "v").groupBy("dim", "pack").applyInArrow(
        pack_queries, "dim int, pack long, qids binary, own binary, qvals binary"), "packs")
    # every pack meets every block of its length: packs, which are small, are copied for the blocks; a block is copied
    # only for as many lanes of packs as it takes to keep the partitions busy
    parts, count = partitions_for(blocks, 2), blocks.count()
    lanes = max(1, min(packs.count(), -(-parts // max(1, count))))
    numbers = blocks.groupBy("dim").agg(F.collect_list("block").alias("blocks"))
    void = lambda *names: [F.lit(None).cast("binary").alias(n) for n in names]
    left = blocks.select("dim", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), F.lit(-1).cast("long").alias("pack"),
                         "ids", "rows", "vals", *void("qids", "own", "qvals"))
    right = packs.join(numbers, "dim").select("dim", F.explode("blocks").alias("block"), F.pmod("pack", F.lit(lanes)).cast("long").alias("lane"), "pack",
                                              *void("ids", "rows", "vals"), "qids", "own", "qvals")
    units = left.unionByName(right).repartition(parts, "dim", "block", "lane").sortWithinPartitions("dim", "block", "lane", "pack")

    def search(batches):
        index = None
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda c, kind: np.frombuffer(batch.column(c)[i].as_buffer(), kind)
                dim = batch.column("dim")[i].as_py()
                if batch.column("pack")[i].as_py() < 0:  # a block comes before its packs
                    index = Index(get("ids", "<i8"), get("rows", "<i8"), get("vals", "<i8").reshape(-1, dim))
                    continue
                out = [(q, v, s, own) for q, own, x in zip(get("qids", "<i8").tolist(), get("own", "<i8").tolist(),
                                                      get("qvals", "<i8").reshape(-1, dim)) for v, s in index.best(x, own, k)]
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(4)],
                                                 ["query_id", "vec_id", "score", "own"])
    found = units.mapInArrow(search, "query_id long, vec_id long, score long, own long")
    return found.selectExpr("query_id", "CAST(row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS INT) AS rank",
                            "vec_id", "score").where(F.col("rank") <= k)
