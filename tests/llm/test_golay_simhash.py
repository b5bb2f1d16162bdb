import random

import numpy as np
import pytest
import xxhash
from ecospark.llm import golay_simhash as g
from ecospark.llm.common import materialize
from fixtures import SF, clashing, edge_rows, needs_data, no_docs


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(x, seed=42).intdigest() for x in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def roots(nodes, pairs):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def brute(rows):
    """(doc_id, fingerprint, component_id) by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2]
    of, out = roots(range(len(rows)), pairs), []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in of if of[j] == of[k] and rows[j][0] is not None]
        out.append((str(i), f"{fps[k]:016x}", str(min(ids, default=None))))
    return sorted(out)


def check(df, rows):
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in df.collect()) == brute(rows)


def test_code_is_perfect_and_near_words_share_a_key():
    rng = np.random.default_rng(1)
    assert (g._errors() >= 0).all()
    words = rng.integers(0, 1 << 23, 300)
    keys = g.fuzzy_keys(words)
    assert set((keys >= 0).sum(1)) <= {1, 6}
    for _ in range(20):
        flips = np.array([sum(1 << int(b) for b in rng.choice(23, rng.integers(0, 3), replace=False)) for _ in words])
        other = g.fuzzy_keys(words ^ flips)
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(keys, other))


@pytest.mark.parametrize("run_limit", [g.RUN, 5])
def test_links_have_the_components_of_all_pairs(spark, run_limit):
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(60):
            fps.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = materialize(spark.createDataFrame([(f,) for f in signed], "fp long"), "t")
    got = [(r.a, r.b) for r in g.links(nodes, run_limit).collect()]
    want = [(a, b) for k, a in enumerate(signed) for b in signed[:k] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    assert roots(signed, got) == roots(signed, want)


def test_edge_rows(spark):
    check(g.components_of(clashing(spark)), [r[:2] for r in edge_rows()])
    assert g.components_of(no_docs(spark)).count() == 0


def test_hashes_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 37}" for i in range(500))
    whole = g.fingerprint(g.shingle_hashes(text))
    monkeypatch.setattr(g, "PART", 64)
    assert g.fingerprint(g.shingle_hashes(text)) == whole == plain_fingerprint(text)


@needs_data
def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(g.components_of(docs), [(r.doc_id, r.text) for r in docs.collect()])
