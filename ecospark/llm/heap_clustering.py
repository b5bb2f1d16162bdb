"""Exact integer k-means with heap-ordered bounds.

When a vector is scanned, its distances to all centroids give an upper bound (its own centroid) and a lower bound (the
nearest other one); their difference is the vector's gap.  A round can lower the gap of the vectors of a cluster by no
more than the move of its own centroid and the greatest move of another one; these moves accumulate to the cluster's
drift.  Each cluster keeps a heap of its vectors ordered by gap plus the drift at the scan.  As long as that key is above
the present drift the vector's nearest centroid cannot have changed, so a round takes from the top of each heap the
entries whose gap has expired, scans those vectors exactly and pushes them into the heaps of their clusters.  The others
are not touched; only vectors that changed their cluster are added to and taken from the sums.

Vectors are packed into blocks of up to ``BLOCK`` rows without a shuffle; a block's row holds its ids, components,
clusters and heaps.  A round is one pass over the blocks that writes the table anew and deletes the one before it, and
the sums of k centroids a block are added up by Spark; the driver holds the centroids, their drifts and sums.

Components are integers, so distances, sums and means are exact; bounds are square roots in floating point and are
widened by ``SLACK``, which can only cause a needless scan.  Ties go to the smaller centroid number.

Edge cases: vectors that are null, of another length, or hold a null or non-finite component take no part.  A component
beyond ``LIMIT`` after quantisation, where a squared distance would not fit a long, is an error.  A null id takes part
but starts no centroid; rows that share an id are rows of their own, and each may start one.  Fewer rows than k start
fewer centroids; a cluster that empties keeps its centroid.  An empty table gives an empty result.  Extra columns are
left out.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecospark.llm.common import arrow_map, drop_scratch, materialize

BLOCK = 8192
#: Greatest magnitude of a component: 64 squared differences fit a long.
LIMIT = 1 << 27
#: Components up to this magnitude have squared distances that are exact in floating point.
EXACT = 1 << 22
#: Relative widening of bounds.
SLACK = 1e-9


def quantised(vectors: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v, the components as integers, of the vectors that take part."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    sound = (F.size(x) == dim) & F.forall(x, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)))
    v = F.transform(x, lambda e: F.when(F.abs(e) * scale < LIMIT, F.floor(e * scale).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component beyond {LIMIT // scale}")).cast("int")))
    return vectors.where(F.coalesce(sound, F.lit(False))).select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The vectors of the k smallest digests of ``seed:vec_id``, in that order."""
    known = rows.where("vec_id IS NOT NULL")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    best = known.orderBy(digest, "vec_id", "v").limit(k).collect()
    return np.array([r["v"] for r in best], np.int64)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances [vector, centroid]."""
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    if most <= EXACT and vectors.shape[1] <= 256:
        v, c = vectors.astype(np.float64), centroids.astype(np.float64)
        return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)).astype(np.int64)
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for j, c in enumerate(centroids.astype(np.int64)):
        step = vectors.astype(np.int64) - c
        out[:, j] = (step * step).sum(1)
    return out


def scan(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid, squared distance and gap of each vector."""
    cluster, distance, gap = np.zeros(len(vectors), np.int32), np.zeros(len(vectors), np.int64), np.full(len(vectors), np.inf)
    for at in range(0, len(vectors), 4096):
        d = distances(vectors[at:at + 4096], centroids)
        rows = np.arange(len(d))
        best = d.argmin(1)  # the first of equal ones
        upper = d[rows, best]
        cluster[at:at + 4096], distance[at:at + 4096] = best, upper
        if len(centroids) > 1:
            d[rows, best] = np.iinfo(np.int64).max
            high, low = np.sqrt(upper.astype(float)), np.sqrt(d.min(1).astype(float))
            gap[at:at + 4096] = low * (1 - SLACK) - high * (1 + SLACK)
    return cluster, distance, gap


class Heap:
    """A binary heap in an array: entry i is not above entries 2i + 1 and 2i + 2."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        self.keys, self.rows = keys, rows

    def pop_expired(self, drift: float) -> np.ndarray:
        """Take out the rows whose key is not above ``drift``.  They hang together from the top, so the walk ends a
        level below them; what is left is a heap again once pushed into."""
        out, level = [], np.zeros(min(1, len(self.keys)), np.int64)
        while len(level):
            level = level[self.keys[level] <= drift]
            out.append(level)
            level = np.concatenate([2 * level + 1, 2 * level + 2])
            level = level[level < len(self.keys)]
        taken = np.concatenate(out) if out else np.zeros(0, np.int64)
        rows = self.rows[taken]
        if len(taken):
            keep = np.ones(len(self.keys), bool)
            keep[taken] = False
            self._ordered(self.keys[keep], self.rows[keep])
        return rows

    def push(self, keys: np.ndarray, rows: np.ndarray) -> None:
        if len(keys):
            self._ordered(np.concatenate([self.keys, keys]), np.concatenate([self.rows, rows]))

    def _ordered(self, keys: np.ndarray, rows: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")  # an ordered array is a heap
        self.keys, self.rows = keys[order], rows[order]


class Blocks:
    """A block: ids, vectors, cluster of each row, and the heaps (none before the first scan)."""

    FIELDS = "ids array<long>, vectors binary, clusters binary, sizes binary, keys binary, rows binary"

    def __init__(self, ids, vectors: np.ndarray, clusters=None, heaps=None):
        self.ids, self.vectors, self.clusters, self.heaps = ids, vectors, clusters, heaps

    @classmethod
    def read(cls, batch: pa.RecordBatch, i: int, dim: int) -> Blocks:
        get = lambda name, kind: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
        vectors = get("vectors", "<i4").reshape(-1, dim)
        ids = batch.column("ids")[i].values
        if not batch.column("sizes")[i].is_valid:
            return cls(ids, vectors)
        cuts = np.cumsum([0, *get("sizes", "<i8")])
        keys, rows = get("keys", "<f8"), get("rows", "<i4")
        heaps = [Heap(keys[a:b], rows[a:b]) for a, b in zip(cuts, cuts[1:])]
        return cls(ids, vectors, get("clusters", "<i4").copy(), heaps)

    def row(self) -> list:
        if self.heaps is None:
            return [self.ids, self.vectors.astype("<i4").tobytes(), None, None, None, None]
        return [self.ids, self.vectors.tobytes(), self.clusters.astype("<i4").tobytes(),
                np.array([len(h.keys) for h in self.heaps], "<i8").tobytes(),
                np.concatenate([h.keys for h in self.heaps]).astype("<f8").tobytes(),
                np.concatenate([h.rows for h in self.heaps]).astype("<i4").tobytes()]

    def advance(self, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Scan the rows whose gap has expired.  Returns what this adds to the sums and counts of the clusters, and
        how many rows were scanned."""
        sums, counts = np.zeros((len(centroids), self.vectors.shape[1]), np.int64), np.zeros(len(centroids), np.int64)
        if self.heaps is None:
            rows, before = np.arange(len(self.vectors), dtype=np.int32), None
            self.clusters = np.zeros(len(rows), np.int32)
            self.heaps = [Heap(np.zeros(0), np.zeros(0, np.int32)) for _ in centroids]
        else:
            rows = np.concatenate([h.pop_expired(d) for h, d in zip(self.heaps, drift)])
            before = self.clusters[rows]
        cluster, _, gap = scan(self.vectors[rows], centroids)
        self.clusters[rows] = cluster
        for c, heap in enumerate(self.heaps):
            mine = cluster == c
            heap.push(gap[mine] + drift[c], rows[mine])
            came = mine if before is None else mine & (before != c)
            left = np.zeros(0, bool) if before is None else (before == c) & ~mine
            sums[c] = self.vectors[rows[came]].sum(0, dtype=np.int64) - (self.vectors[rows[left]].sum(0, dtype=np.int64) if left.any() else 0)
            counts[c] = came.sum() - left.sum()
        return sums, counts, len(rows)


def pack(rows: DataFrame, dim: int, block: int = BLOCK) -> DataFrame:
    """Blocks of the vectors of a task, without heaps; ``BLOCK`` rows each but the last."""
    def out(held):
        ids = pa.concat_arrays([b.column("vec_id") for b in held])
        flat = np.concatenate([b.column("v").flatten().to_numpy(zero_copy_only=False) for b in held])
        return _batch([Blocks(ids, flat.reshape(-1, dim)).row()])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, block - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == block:
                    yield out(held)
                    held, n = [], 0
        if held:
            yield out(held)
    return rows.mapInArrow(run, Blocks.FIELDS)


_TYPES = [pa.list_(pa.int64())] + [pa.binary()] * 5
_NAMES = ["ids", "vectors", "clusters", "sizes", "keys", "rows"]


def _batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(_TYPES)], _NAMES)


def _round(blocks: DataFrame, centroids: np.ndarray, drift: np.ndarray, dim: int) -> DataFrame:
    """The blocks after a round, with sums, counts (of what came less what left) and the number of rows scanned."""
    def per_batch(batch):
        for i in range(batch.num_rows):
            block = Blocks.read(batch, i, dim)
            sums, counts, scanned = block.advance(centroids, drift)
            out = _batch([block.row()])
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array([sums.tolist()], pa.list_(pa.list_(pa.int64()))),
                                              pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([scanned], pa.int64())],
                                             [*_NAMES, "sums", "counts", "scanned"])
    return arrow_map(blocks.select(*_NAMES), per_batch, Blocks.FIELDS + ", sums array<array<long>>, counts array<long>, scanned long")


def _change(blocks: DataFrame, k: int, dim: int) -> tuple[list[list[int]], list[int], int]:
    """Sums and counts of all blocks (whole numbers of any size) and the rows scanned."""
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    parts = blocks.select("counts", "scanned", F.posexplode("sums").alias("c", "s"))
    found = parts.groupBy("c").agg(F.sum(F.col("counts")[F.col("c")]).alias("n"), F.sum("scanned").alias("scanned"),
                                   F.array(*[wide(F.col("s")[d]) for d in range(dim)]).alias("s")).collect()
    sums, counts = [[0] * dim for _ in range(k)], [0] * k
    for r in found:
        sums[r["c"]], counts[r["c"]] = [int(x) for x in r["s"]], r["n"]
    return sums, counts, found[0]["scanned"] if found else 0


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, dim: int = 64, scale: int = 1024,
            id_col: str = "vec_id", vector_col: str = "embedding", log: list | None = None) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part.
    ``log`` takes the rows scanned in each round."""
    rows = quantised(vectors, dim, scale, id_col, vector_col)
    centroids = first_centroids(rows, k, seed)
    k = len(centroids)
    blocks = materialize(pack(rows, dim), "cluster-blocks")
    drift, sums, counts = np.zeros(k), [[0] * dim for _ in range(k)], [0] * k
    for n in range(rounds + 1 if k else 0):
        after = materialize(_round(blocks, centroids, drift, dim), "cluster-blocks")
        drop_scratch(blocks)
        blocks = after
        if n == rounds:
            break
        more, came, scanned = _change(blocks, k, dim)
        if log is not None:
            log.append(scanned)
        sums = [[a + b for a, b in zip(x, y)] for x, y in zip(sums, more)]
        counts = [a + b for a, b in zip(counts, came)]
        moved = np.array([[x // c for x in s] if c else list(old) for s, c, old in zip(sums, counts, centroids.tolist())], np.int64)
        step = moved - centroids
        far = np.sqrt((step.astype(float) ** 2).sum(1)) * (1 + SLACK)
        others = np.array([np.delete(far, c).max(initial=0.0) for c in range(k)])
        drift, centroids = (drift + far + others) * (1 + SLACK), moved
    return _described(blocks, centroids, dim)


def _described(blocks: DataFrame, centroids: np.ndarray, dim: int) -> DataFrame:
    """A row for each vector of the last round."""
    def per_batch(batch):
        for i in range(batch.num_rows):
            block = Blocks.read(batch, i, dim)
            step = block.vectors.astype(np.int64) - centroids[block.clusters]
            yield pa.RecordBatch.from_arrays([block.ids, pa.array(block.clusters), pa.array((step * step).sum(1))],
                                             ["vec_id", "cluster", "distance"])
    found = materialize(arrow_map(blocks.select(*_NAMES), per_batch, "vec_id long, cluster int, distance long"), "clusters")
    drop_scratch(blocks)
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return found.select("vec_id", "cluster", "distance", _by_cluster(inertia, "long").alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
                        _by_cluster(dict(enumerate(digest)), "string").alias("centroid_sha256"))


def _by_cluster(values: dict, kind: str) -> Column:
    """The value of each row's cluster."""
    return reduce(lambda out, x: F.when(F.col("cluster") == x[0], F.lit(x[1])).otherwise(out), values.items(), F.lit(None)).cast(kind)
