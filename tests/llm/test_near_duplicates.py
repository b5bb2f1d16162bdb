import random

import numpy as np
import pytest
from ecospark.llm import near_duplicates as m
from fixtures import SF, clashing, edge_rows, needs_data, no_docs


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    """(doc_id, n_shingles, component_id) of rows with distinct ids or equal texts."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for k, (i, a) in enumerate(sets):
        for j, c in sets[:k]:
            if i is not None and j is not None and a and 100 * len(a & c) >= 75 * len(a | c):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((str(i), len(a), str(find(i))) for i, a in sets)


def check(df, rows):
    out = df.collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == brute(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"] or r["doc_id"] is None) for r in out)


def near_group(n, words, edits, seed):
    rng = random.Random(seed)
    base = [f"b{seed}x{i}" for i in range(words)]
    out = []
    for k in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def test_edge_rows(spark):
    check(m.components_of(clashing(spark)), [r[:2] for r in edge_rows()])
    assert m.components_of(no_docs(spark)).count() == 0


@pytest.mark.parametrize("side", [8, 512])
def test_groups_of_copies(spark, monkeypatch, side):
    """A large group of near copies whose ends differ, exact copies, and a passage that many documents share."""
    monkeypatch.setattr(m, "SIDE", side)
    texts = near_group(150, 120, 6, 1) + near_group(30, 60, 3, 2) + ["same text of six words here"] * 40
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"d{k}w{i}" for i in range(50)) for k in range(40)]
    rows = list(enumerate(texts))
    random.Random(3).shuffle(rows)
    check(m.components_of(spark.createDataFrame(rows, "doc_id long, text string")), rows)


@needs_data
def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(m.components_of(docs), [(r.doc_id, r.text) for r in docs.collect()])


def test_every_pair_within_the_distance_shares_a_key(spark):
    rng = np.random.default_rng(5)
    sig = rng.integers(0, 1 << 16, m.CODES).astype("<u2")
    rows = [(0, 9, bytearray(sig.tobytes()))]
    for k in range(1, 60):
        other = sig.copy()
        at = rng.choice(m.CODES, m.FAR, replace=False)
        other[at] ^= 1 + rng.integers(0, 1000, m.FAR).astype("<u2")
        rows.append((k, 9, bytearray(other.tobytes())))
    keys = m.key_rows(spark.createDataFrame(rows, "rep long, n long, sig binary")).collect()
    mine = {r["key"] for r in keys if r["rep"] == 0}
    assert len(mine) == m.CODES
    assert {r["rep"] for r in keys if r["key"] in mine} == set(range(60))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    a, c = np.sort(x[:3000]), np.sort(x[400:3400])  # similarity 0.76
    codes = [np.frombuffer(m.signature(s), "<u2") for s in (a, c)]
    assert 0.55 < (codes[0] == codes[1]).mean() < 0.95


def test_connected(spark):
    path = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7)]
    out = m.connected(spark.createDataFrame(path, "a long, b long"))
    assert sorted(tuple(r) for r in out.collect()) == [(i, 0) for i in range(41)] + [(100, 100), (101, 100)]
    assert m.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_first_keeps_one_row_of_each_group(spark):
    docs = clashing(spark)
    kept = m.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 7, 8, 10, None, 12, 14, 15]))
