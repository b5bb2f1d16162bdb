import re

import numpy as np
import pandas as pd
from ecospark.llm import quality_rules as q
from fixtures import SF, clashing, edge_docs, edge_rows, labels, needs_data, no_docs, no_labels

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def check(df, rows):
    want = sorted((-1 if i is None else i, *brute(t)) for i, t in rows)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], *(r[c] for c in cols)) for r in df.collect())
    assert got == want


def test_counts_of_edge_rows(spark):
    check(q.rule_stats(clashing(spark)), [r[:2] for r in edge_rows()])


@needs_data
def test_counts_and_verdicts_of_documents(spark):
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = q.apply_rules(docs, marks, trees=32).toPandas()
    check(q.rule_stats(docs), [(r.doc_id, r.text) for r in docs.collect()])
    failed = (out.n_words < 50) | (100 * out.n_repeat_words > 50 * out.n_words)
    assert (out.base_failed == failed).all() and not (out.kept & failed).any()
    assert (out.kept == (~failed & (out.anomaly <= out.threshold))).all()
    known = out.merge(marks.toPandas(), on="doc_id")
    assert (known[known.quality == 1].anomaly > known.threshold.iloc[0]).mean() <= 0.01 + 1e-9
    assert (known[known.quality == 0].anomaly > known.threshold.iloc[0]).mean() > 0.3


def test_without_labels_or_rows(spark):
    out = q.apply_rules(edge_docs(spark), no_labels(spark), trees=4).collect()
    assert len(out) == len(edge_rows()) and all(r["kept"] == (not r["base_failed"]) for r in out)
    assert q.apply_rules(no_docs(spark), labels(spark), trees=4).count() == 0


def test_forest_finds_the_odd_rows():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(9, 1, (10, 3))])
    score = q.grow(x, 64, 128, 1).score(x)
    assert score[500:].min() > np.quantile(score[:500], 0.99)


def test_calibration_is_bounded_by_the_false_share():
    counts = [(0.4, True, 98), (0.7, True, 2), (0.6, False, 30), (0.8, False, 20)]
    assert q.calibrate(counts, 0.01) == 0.7  # rows above 0.7 only: no good one
    assert q.calibrate(counts, 0.02) == 0.4
    assert q.calibrate([(0.4, True, 3)], 0.5) == float("inf")


def test_repeated_words_of_many_distinct_words():
    ids = np.concatenate([np.arange(3_000_000), np.arange(5)])
    assert q.repeated_words(ids) == 10
    assert isinstance(q.features(pd.DataFrame([dict.fromkeys(q.COUNTS, 0)])), np.ndarray)
