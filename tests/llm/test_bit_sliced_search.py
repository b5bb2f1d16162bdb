import math
import random

import numpy as np
import pytest
from ecospark.llm import bit_sliced_search as b
from pyspark.sql import functions as F


def brute(rows, k, wanted):
    sound = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows)
             if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in sound:
        if i is None or not wanted(i):
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j) for m, j, v in sound if m != n and len(v) == len(q))
        out += [(i, r + 1, -s) for r, (s, _, j) in enumerate(scores[:k])]
    return sorted(out)


def vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumn("score", F.lit(1)).withColumn("block", F.lit("x")).withColumn("row", F.lit(None).cast("string"))


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(b, "BLOCK", 7)
    monkeypatch.setattr(b, "PACK", 2)
    rng = random.Random(4)
    f32 = lambda x: float(np.float32(x))
    rows = [(i, [f32(rng.uniform(-1, 1)) for _ in range(6)]) for i in range(30)]
    rows += [(i, rows[3][1]) for i in range(40, 52)]  # ties
    rows += [(50, rows[3][1]), (60, None), (62, []), (64, [None] * 6), (66, [math.nan] * 6), (68, [math.inf] * 6),
             (70, [0.0] * 6), (72, [1.0, 2.0]), (74, [3.0, -1.0]), (None, rows[5][1])]
    out = b.top_k(vectors(spark, rows), F.col("vec_id") % 2 == 0, 4).collect()
    got = sorted((r["query_id"], r["rank"], r["score"]) for r in out)
    assert got == brute(rows, 4, lambda i: i % 2 == 0)
    for q in (2, 40):  # ties go to the smaller id
        mine = sorted([r for r in out if r["query_id"] == q], key=lambda r: r["rank"])
        assert mine == sorted(mine, key=lambda r: (-r["score"], r["vec_id"]))
    best = [r["vec_id"] for r in sorted((r for r in out if r["query_id"] == 40), key=lambda r: r["rank"])]
    own = [r for r in rows if r[0] == 40][0][1]
    scores = {i: sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(own, v)) for i, v in rows
              if i is not None and v and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v) and i != 40}
    assert best == [i for i, _ in sorted(scores.items(), key=lambda x: (-x[1], x[0]))][:4]


def test_great_components_take_part_and_greater_ones_are_an_error(spark):
    rows = [(0, [2.0, 1.0]), (1, [40000.0, 1.0]), (2, [3.0, -float(1 << 30)]), (3, [-float(1 << 40), 5.0])]
    out = b.top_k(vectors(spark, rows), F.col("vec_id") == 0, 3).collect()
    assert sorted((r["query_id"], r["rank"], r["score"]) for r in out) == brute(rows, 3, lambda i: i == 0)
    with pytest.raises(Exception, match="a component beyond"):
        b.top_k(vectors(spark, [(0, [1e30, 1.0])]), F.col("vec_id") == 0).count()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert b.top_k(empty, F.col("vec_id") % 2 == 0).count() == 0


@pytest.mark.parametrize("n", [1, 5, 64, 65, 1000])
def test_index_sums_and_selects(n):
    rng = np.random.default_rng(n)
    values = rng.integers(-300, 300, (n, 9)).astype(np.int32)
    values[n // 2:] = values[0]
    index = b.Index(np.arange(n) * 3, np.arange(n), values)
    for query in (values[0], rng.integers(-300, 300, 9).astype(np.int32), np.zeros(9, np.int32)):
        total, constant = index.product(query)
        bits = np.stack([np.unpackbits(t.view(np.uint8), bitorder="little")[:n].astype(np.int64) << w for w, t in enumerate(total)])
        exact = values.astype(np.int64) @ query
        assert (bits.sum(0) + constant == exact).all()
        order = sorted((i for i in range(n) if i != 0), key=lambda i: (-exact[i], i))[:5]
        assert index.best(query, 0, 5) == [(3 * i, int(exact[i])) for i in order]
