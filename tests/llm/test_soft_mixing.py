import numpy as np
from ecospark.llm import soft_mixing as x
from ecospark.llm import queries
from fixtures import DOCS, SF, clashing, edge_docs, edge_rows, labels, needs_data, no_docs, no_labels

COLUMNS = ["quality", "toxic"]


def solved(p, n, target, rounds):
    """The same rounds on one machine."""
    r = last = np.ones(len(p))
    start = n @ p
    reached = before = start
    error, age = np.inf, 0
    for _ in range(rounds):
        gap = reached - target
        if np.all(np.abs(gap) <= 1e-3 * np.maximum(target, 1)):
            break
        now = (gap * gap / start).sum()
        age = age + 1 if now < error else 0
        error, m = now, max(0, (age - 1) / (age + 2))
        y = r + m * (r - last)
        r, last = np.maximum(0, y - p @ (((n * y) @ p - target) / start)), r
        before, reached = reached, (n * r) @ p
    return r


def test_rates_meet_the_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 500, 400)
    members = spark.createDataFrame([(i, int(n[i]), [float(v) for v in p[i]]) for i in range(400)],
                                    "doc_id long, n_tokens long, p array<double>").repartition(5)
    fit = x.fit_rates(members, 3, weights=np.array([0.6, 0.1, 0.3]), rounds=60)
    assert np.allclose(fit.target, n.sum() * np.array([0.6, 0.1, 0.3]))
    assert np.all(np.abs(fit.reached - fit.target) <= 1e-3 * fit.target)
    out = x.with_rates(members, 3, fit).orderBy("doc_id").toPandas()
    assert (out.rate >= 0).all() and np.allclose(out.rate, solved(p, n, fit.target, 60), atol=1e-6)
    assert np.allclose((out.rate * n) @ p, fit.reached)
    assert (np.abs(out.copies - out.rate) < 1).all() and abs(out.copies.sum() - out.rate.sum()) < 0.1 * out.rate.sum()


@needs_data
def test_documents(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out, fit = x.mix(docs, marks, COLUMNS, factors={"quality1_toxic1": 0.1, "quality0_toxic0": 0.1, "quality0_toxic1": 0.1})
    rows = out.join(marks, "doc_id").toPandas()
    assert np.all(np.abs(fit.reached - fit.target) <= 1e-2 * np.maximum(fit.target, 1))
    clean = (rows.quality == 1) & (rows.toxic == 0)
    assert rows[clean].rate.mean() > 0.9 and rows[~clean].rate.mean() < 0.5
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in out.collect()} == {i: len(t.split()) for i, t in texts.items()}
    assert all(abs(sum(r.p) - 1) < 1e-9 for r in out.collect())


def test_edge_rows(spark):
    docs = clashing(spark)
    out, _ = x.mix(docs, labels(spark), COLUMNS, weights={"quality1_toxic0": 1.0})
    assert out.count() == len(edge_rows()) and all(r["rate"] >= 0 for r in out.collect())
    out, fit = x.mix(edge_docs(spark), no_labels(spark), COLUMNS, factors={})
    assert {round(r["rate"], 6) for r in out.collect()} == {1.0} and not fit.rounds
    out, _ = x.mix(no_docs(spark), labels(spark), COLUMNS, weights={"quality1_toxic0": 1.0})
    assert out.count() == 0
    kept = x.keep_mixed(docs, labels(spark), COLUMNS, {})
    assert kept.columns == docs.columns and kept.count() == docs.count()


def domain_docs(spark, n=1600):
    """Documents that are clearly in one of the four domains, with ids, labels and 60 words each."""
    rng = np.random.default_rng(3)
    rows, marks = [], []
    for i in range(n):
        q, t = (i >> 1) & 1, i & 1
        words = [f"{'good' if q else 'junk'}{k}" for k in rng.integers(0, 30, 30)] + \
            [f"{'vile' if t else 'kind'}{k}" for k in rng.integers(0, 30, 30)]
        rows.append((i, " ".join(words), "en", "src", 1))
        marks.append((i, q, t))
    return spark.createDataFrame(rows, DOCS).repartition(3), labels(spark, marks)


def test_stage_meets_the_targets(spark):
    docs, marks = domain_docs(spark)
    for wanted in (0.1, 0.3):
        factors = {"quality1_toxic0": 1.0, "quality1_toxic1": wanted, "quality0_toxic0": wanted, "quality0_toxic1": 0.0}
        kept = x.keep_mixed(docs, marks, COLUMNS, factors)
        rates, fit = x.mix(docs, marks, COLUMNS, factors=factors)
        expected = {r.doc_id: r.copies for r in rates.collect()}
        got = kept.groupBy("doc_id").count().collect()
        assert kept.columns == docs.columns and {r.doc_id: r["count"] for r in got} == {i: c for i, c in expected.items() if c}
        p = rates.selectExpr("doc_id", *[f"p[{k}] p{k}" for k in range(4)], "n_tokens", "copies").toPandas()
        totals = (p.n_tokens * p.copies).to_numpy() @ p[[f"p{k}" for k in range(4)]].to_numpy()
        assert np.all(np.abs(totals - fit.target) <= 0.04 * fit.start), (wanted, totals, fit.target, fit.start)


def test_stage_rows_with_one_id(spark):
    docs, marks = domain_docs(spark, 400)
    text = " ".join(f"good{k} kind{k}" for k in range(30))
    more = spark.createDataFrame([(0, text, "en", "b", 1), (None, text, "en", "c", 1)], DOCS)
    kept = x.keep_mixed(docs.union(more), marks.where("doc_id > 0"), COLUMNS, {"quality0_toxic0": 0.0, "quality0_toxic1": 0.0})
    rows = {(r.doc_id, r.source) for r in kept.collect()}
    assert (0, "b") in rows and (0, "src") not in rows and (None, "c") in rows


def test_a_fit_goes_on_until_its_error_stands_still(spark):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    members = spark.createDataFrame([(i, 100, [float(v) for v in p[i]]) for i in range(400)],
                                    "doc_id long, n_tokens long, p array<double>").coalesce(1)
    fit = x.fit_rates(members, 3, factors=np.array([1.0, 0.1, 0.0]))
    assert len(fit.rounds) > 40 or fit.met.all()
    assert fit.met.tolist() == [bool(v) for v in np.abs(fit.reached - fit.target) <=
                                [1e-3 * fit.target[0], 1e-3 * fit.target[1], 1e-2 * fit.start[2]]]
    few = x.fit_rates(members, 3, factors=np.array([1.0, 0.1, 0.0]), rounds=2)
    assert len(few.rounds) == 2 and not few.met.all()


@needs_data
def test_query_meets_its_targets(spark):
    out = queries.QUERIES["op9_soft_mixing"](spark, SF).toPandas()
    total = out.n_tokens.sum()
    for name, weight in queries.MIX_WEIGHTS.items():
        target, reached = out[f"target_{name}"][0], out[f"reached_{name}"][0]
        assert np.isclose(target, total * weight) and abs(reached - target) <= 1e-3 * target
        assert np.isclose((out.rate * out.n_tokens * out[f"p_{name}"]).sum(), reached)


def test_scores_are_sums_over_distinct_words(monkeypatch):
    """Whatever words the table has forgotten in between."""
    rng = np.random.default_rng(6)
    models = [(np.sort(rng.choice(x.SLOTS, 400_000, replace=False)), rng.normal(size=400_000).astype(np.float32), 0.1 * k) for k in (1, 2)]
    texts = ["Good day, GOOD day", "", "a bb ccc dddd eeeee ffffff gggggggg", "x" * 500] + [f"w{k} v{k} good" for k in range(40)]
    want = []
    for t in texts:
        slots = [s for w in set(t.split()) for s in x.word_slots(w)] + x.shape_slots(len(t.split()), len(set(t.split())))
        dense = np.zeros((2, x.SLOTS))
        for k, (at, w, _) in enumerate(models):
            dense[k, at] = w
        want.append(1 / (1 + np.exp(-(dense[:, slots].sum(1) + [0.1, 0.2]))))
    monkeypatch.setattr(x, "CACHE_WORDS", 12)
    scorer = x.Scorer(models)
    for k in range(0, len(texts), 3):
        for _ in range(2):
            assert np.allclose(scorer(texts[k:k + 3])[1], want[k:k + 3], atol=1e-5)


def test_stored_rates_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(7)
    p = rng.dirichlet([0.3, 0.3, 0.3], 200)
    members = spark.createDataFrame([(i, 50 + i, [float(v) for v in p[i]]) for i in range(200)],
                                    "doc_id long, n_tokens long, p array<double>").repartition(3)
    fits = []
    for stored in (1, 3, 1000):
        monkeypatch.setattr(x, "STORED", stored)
        fits.append(x.fit_rates(members, 3, factors=np.array([1.0, 0.2, 0.5]), rounds=12))
    assert all(np.allclose(f.reached, fits[0].reached) and len(f.rounds) == len(fits[0].rounds) for f in fits)
