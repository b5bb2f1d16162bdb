import random
import zlib

import pytest
from ecospark.llm import sharding as s
from fixtures import SF, clashing, edge_rows, needs_data, no_docs


def smallest(sizes, shards):
    def fits(capacity):
        used, room = 1, capacity
        for x in sizes:
            if x > capacity:
                return False
            if x > room:
                used, room = used + 1, capacity
            room -= x
        return used <= shards
    low, high = 1, sum(sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def check(rows, out, shards):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append((i, t))
    first = {t: min((-(1 << 63) if i is None else i) for i, _ in g) for t, g in texts.items()}
    total = {}
    for t, g in texts.items():
        total[first[t]] = total.get(first[t], 0) + len(g) * (len(t.encode()) + 1)
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r)
    if rows:
        assert max(sum(r["size"] for r in g) for g in by.values()) == smallest([total[k] for k in sorted(total)], shards)
    for k, g in by.items():
        assert 0 <= k < shards and sorted(r["slot"] for r in g) == list(range(len(g)))
    place = {}
    for r in out:
        place.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(len(x) == 1 for x in place.values())
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in rows)


def test_edge_rows(spark):
    check([r[:2] for r in edge_rows()], s.shard_documents(clashing(spark), 4).collect(), 4)
    assert s.shard_documents(no_docs(spark), 4).count() == 0


@needs_data
def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], s.shard_documents(docs, 16).collect(), 16)


@pytest.mark.parametrize("seed", range(4))
def test_cuts_are_minimax(spark, monkeypatch, seed):
    """Few parts a round force several rounds of refinement."""
    monkeypatch.setattr(s, "PARTS", 4)
    monkeypatch.setattr(s, "AT_ONCE", 5)
    rng = random.Random(seed)
    keys = list({rng.randrange(-(1 << 62), 1 << 62) for _ in range(200)})
    sizes = [rng.choice([1, 2, 3, 50, 400 if seed % 2 else 7]) for _ in keys]
    capacity, cuts = s.minimax_cuts(spark.createDataFrame(list(zip(keys, sizes)), "key long, size long"), 7)
    ordered = [x for _, x in sorted(zip(keys, sizes))]
    assert capacity == smallest(ordered, 7) and len(cuts) <= 6
    edges = [-(1 << 63), *cuts, 1 << 63]
    assert max(sum(x for k, x in zip(keys, sizes) if a < k <= b) for a, b in zip(edges, edges[1:])) <= capacity
