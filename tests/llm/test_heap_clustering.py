import hashlib
import math

import numpy as np
import pytest
from ecospark.llm import heap_clustering as m
from fixtures import SF, needs_data

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=8, rounds=10, dim=64):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), i, v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, _, v in start]
    v = np.array([x for _, x in kept], object)
    for n in range(rounds + 1):
        d = np.array([((v - np.array(c, object)) ** 2).sum(1) for c in centroids]).T
        best = [min(range(len(centroids)), key=lambda c: (row[c], c)) for row in d]
        if n < rounds:
            for c in range(len(centroids)):
                mine = [x for x, b in zip(v, best) if b == c]
                if mine:
                    centroids[c] = [int(s) // len(mine) for s in np.array(mine, object).sum(0)]
    near = [int(row[b]) for row, b in zip(d, best)]
    of = [sum(x for x, b in zip(near, best) if b == c) for c in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), b, x, of[b], sum(near), digest[b]) for (i, _), b, x in zip(kept, best, near))


def got(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


def some_vectors(n, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (5, 64))
    return [(i, (centres[i % 5] + rng.normal(0, 0.1, 64)).astype("f4").tolist()) for i in range(n)]


@pytest.mark.parametrize("block", [m.BLOCK, 16])
def test_against_a_plain_loop(spark, monkeypatch, block):
    """Ties, repeated rows and ids, nulls, wrong lengths, and clashing names."""
    monkeypatch.setattr(m, "BLOCK", block)
    monkeypatch.setattr(m.pack, "__defaults__", (block,))
    rows = some_vectors(150) + [(7, some_vectors(8)[7][1])] * 3 + [(None, some_vectors(3)[2][1]), (900, None), (901, []), (902, [0.5] * 63),
                                                                  (903, [float("nan")] * 64), (904, [None] * 64), (905, [float("inf")] * 64)]
    rows += [(1000 + i, [0.0] * 64) for i in range(20)] + [(2000, [3.0] * 64)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for extra in ("ids", "rows", "cluster", "c", "sums", "v"):
        df = df.withColumn(extra, df.vec_id)
    log = []
    assert got(m.cluster(df, log=log)) == brute(rows)
    assert log[0] == 175 and min(log) < 175  # later rounds scan the rows whose gap expired


def test_few_rows_and_none(spark):
    assert m.cluster(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = some_vectors(3)
    assert got(m.cluster(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_great_components_are_exact_and_greater_ones_an_error(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(0, 1, 64) * 30_000).astype("f4").tolist()) for i in range(40)]
    assert got(m.cluster(spark.createDataFrame(rows, SCHEMA))) == brute(rows)
    with pytest.raises(Exception, match="a component beyond"):
        m.cluster(spark.createDataFrame([(1, [1e9] * 64)], SCHEMA)).count()


def test_heap_gives_what_is_not_above_the_drift():
    rng = np.random.default_rng(3)
    heap = m.Heap(np.zeros(0), np.zeros(0, np.int32))
    heap.push(keys := rng.normal(0, 1, 100), np.arange(100, dtype=np.int32))
    out = heap.pop_expired(0.3)
    assert sorted(out) == sorted(np.flatnonzero(keys <= 0.3)) and len(heap.keys) == 100 - len(out)
    i = np.arange(1, len(heap.keys))
    assert (heap.keys[(i - 1) // 2] <= heap.keys[i]).all()


@needs_data
def test_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert got(m.cluster(df)) == brute([(r.vec_id, r.embedding) for r in df.collect()])
