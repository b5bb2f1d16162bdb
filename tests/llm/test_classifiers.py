"""Held-out accuracy and edge cases of the quality and the toxicity classifier."""

import math

import numpy as np
import pytest
from ecospark.llm import quality_embeddings, toxicity_ftrl
from ecospark.llm.hashed_words import WordTable, labelled_features, labelled_sample, remainder
from fixtures import clashing, edge_docs, edge_rows, labels, no_docs, no_labels

ROOT = "/root/testdata/sf0.01"
CASES = [(quality_embeddings, "quality", 5, 0, 0.97), (toxicity_ftrl, "toxic", 4, 2, 0.85)]


@pytest.mark.parametrize("module, label, base, held, least", CASES)
def test_held_out_ranking(spark, module, label, base, held, least):
    docs, marks = (spark.read.parquet(f"{ROOT}/{t}.parquet") for t in ("documents", "labels"))
    out = module.score_documents(docs, marks, keep=remainder("doc_id", base) != held)
    known = out.join(marks, "doc_id").where(remainder("doc_id", base) == held).toPandas()
    assert out.count() == docs.count() and len(known) > 50
    order = known.score.rank()
    one = known[label] == 1
    auc = (order[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())
    assert auc >= least


@pytest.mark.parametrize("module", [quality_embeddings, toxicity_ftrl])
def test_edge_rows(spark, module):
    out = [(r["doc_id"], r["score"]) for r in module.score_documents(clashing(spark), labels(spark)).collect()]
    assert sorted(str(i) for i, _ in out) == sorted(str(r[0]) for r in edge_rows())
    assert all(0 <= s <= 1 for _, s in out)
    score = {}
    for i, s in out:
        score.setdefault(i, s)
        assert score[i] == s  # repeated rows
    assert score[8] == score[9] and score[4] == score[5] and score[1] == score[2] == score[3]
    assert module.score_documents(no_docs(spark), labels(spark)).count() == 0
    assert {round(r["score"], 6) for r in module.score_documents(edge_docs(spark), no_labels(spark)).collect()} == {0.5}


def test_keep_good_returns_whole_rows(spark):
    docs = clashing(spark)
    kept = quality_embeddings.keep_good(docs, labels(spark), threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    assert quality_embeddings.keep_good(docs, labels(spark), threshold=1.1).count() == 0


def test_ftrl_is_sparse_and_follows_its_update():
    model = toxicity_ftrl.Ftrl(alpha=0.5, beta=1.0, l1=0.1, l2=0.0)
    at, value = np.array([3, 5]), np.array([1.0, 2.0])
    model.learn(at, value, 1)
    g = -0.5 * value
    sigma = np.abs(g) / 0.5
    assert np.allclose(model.z[at], g - sigma * 0) and np.allclose(model.n[at], g * g)
    want = -(g - np.sign(g) * 0.1) / ((1 + np.abs(g)) / 0.5)
    assert np.allclose(model.weights(at), want) and model.weights(np.array([9]))[0] == 0
    at, w, _ = toxicity_ftrl.train([("good day to you", 0), ("bad fool you", 1)] * 30)
    assert 0 < len(at) < 40 and len(at) == len(w)


def test_scores_are_sums_over_distinct_grams():
    words = "Fool fool, you fool and you"
    slots = [s for w in {toxicity_ftrl.plain_word(w): w for w in words.split()}.values() for s in toxicity_ftrl.word_slots(w)]
    rng = np.random.default_rng(1)
    weights = rng.normal(size=toxicity_ftrl.SLOTS).astype(np.float32)
    hashes = np.array([toxicity_ftrl.word_hash(toxicity_ftrl.plain_word(w)) for w in words.split()], np.uint64)
    total = weights[slots].sum() + weights[toxicity_ftrl.pair_features(hashes)].sum() + 0.3
    got = toxicity_ftrl.Scorer(np.arange(toxicity_ftrl.SLOTS), weights, 0.3)([words])[0]
    assert math.isclose(got, 1 / (1 + math.exp(-total)), rel_tol=1e-4)


def test_compact_weights_equal_the_softmax():
    rng = np.random.default_rng(2)
    m = quality_embeddings.Model(rng.normal(size=(quality_embeddings.SLOTS, 4)), rng.normal(size=(2, 4)), rng.normal(size=2))
    text = "a bb bb ccc"
    words = text.split()
    hashes = np.array([quality_embeddings.word_hash(w) for w in words], np.uint64)
    slots = [s for w in words for s in quality_embeddings.word_slots(w)] + quality_embeddings._pairs(hashes).tolist()
    out = m.layer @ m.vectors[slots].mean(0) + m.bias
    want = np.exp(out[1]) / np.exp(out).sum()
    assert math.isclose(quality_embeddings.Scorer(*m.compact())([text])[0], want, rel_tol=1e-4)


def test_samples_are_bounded_and_whole(spark):
    sample = labelled_sample(edge_docs(spark), labels(spark), "quality", 3)
    assert len(sample) == 3 and all(t for t, _ in sample)
    assert labelled_sample(edge_docs(spark), no_labels(spark), "quality", 3) == []
    table = WordTable(lambda w: (len(w), 1))
    assert [x.tolist() for x in table.rows(["a b a", "", "b"])] == [[0, 1, 0], [], [1]]


def test_features_of_labelled_rows_are_those_of_their_texts(spark):
    """Two label columns in one pass; each has the rows that its own sample has."""
    got = labelled_features(edge_docs(spark), labels(spark), ["quality", "toxic"], 4, quality_embeddings.features)
    for column, rows in zip(("quality", "toxic"), got):
        want = [(*quality_embeddings.features(t), y) for t, y in labelled_sample(edge_docs(spark), labels(spark), column, 4)]
        key = lambda r: (r[2], r[0].tolist(), r[1].tolist())
        assert sorted(map(key, rows)) == sorted(map(key, want))
    assert labelled_features(edge_docs(spark), no_labels(spark), ["quality"], 3, quality_embeddings.features) == [[]]


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(f"w{i % 7} w" for i in range(500))
    whole = quality_embeddings.features(text)
    words = text.split()
    hashes = np.array([quality_embeddings.word_hash(w) for w in words], np.uint64)
    plain = np.bincount([s for w in words for s in quality_embeddings.word_slots(w)] + quality_embeddings._pairs(hashes).tolist(),
                        minlength=quality_embeddings.SLOTS)
    monkeypatch.setattr(quality_embeddings, "WORDS_HELD", 64)
    for place, count in (whole, quality_embeddings.features(text)):
        assert (plain[place] == count).all() and count.sum() == plain.sum()


def test_training_follows_a_plain_loop():
    """Two steps of gradient descent written out."""
    q = quality_embeddings
    sample = [(np.array([1, 5]), np.array([1, 3]), 1), (np.array([5, 9]), np.array([2, 2]), 0)]
    got = q.train(sample, epochs=1, rate=0.5, seed=5)
    rng = np.random.default_rng(5)
    vectors, layer, bias = rng.uniform(-1, 1, (q.SLOTS, q.DIM)) / q.DIM, np.zeros((2, q.DIM)), np.array([0.0, 0.0])
    for n, k in enumerate(rng.permutation(2)):
        place, count, label = sample[k]
        part, pace = count / count.sum(), 0.5 * (1 - n / 2)
        mean = sum(w * vectors[s] for w, s in zip(part, place))
        p = np.exp(layer @ mean + bias)
        p /= p.sum()
        p[label] -= 1
        back = p @ layer
        layer, bias = layer - pace * np.outer(p, mean), bias - pace * 0.1 * p
        for w, s in zip(part, place):
            vectors[s] -= pace * 20 * w * back
    assert np.allclose(got.vectors, vectors, atol=1e-6) and np.allclose(got.layer, layer, atol=1e-6) and np.allclose(got.bias, bias, atol=1e-6)
