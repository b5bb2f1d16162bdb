"""The pipeline's rows against a plain run of each stage on one machine."""

import corpus_pipeline
import sentencepiece
from ecospark.llm import queries, quality_embeddings, secrets, soft_mixing
from ecospark.llm.common import materialize
from fixtures import SF, needs_data
from test_near_duplicates import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@needs_data
def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "MinHash near-dedup", "secret scans",
                                                      "mixing to target weights", "SentencePiece encoding"]
    docs, marks = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    stage = dict(corpus_pipeline.STAGES)

    score = {r.doc_id: r.score for r in quality_embeddings.score_documents(docs, marks).collect()}
    good = materialize(stage["quality classifier"](spark, docs, SF), "t")
    assert good.columns == COLUMNS
    rows = {r.doc_id: r for r in good.collect()}
    assert set(rows) == {i for i, s in score.items() if s >= 0.3}
    known = {r.doc_id: r.quality for r in marks.collect()}
    # 87 labels are too few to learn junk from; clean documents stay (accuracy is held in test_classifiers)
    assert sum(i in rows for i, q in known.items() if q == 1) >= 0.97 * sum(known.values())

    one = materialize(stage["MinHash near-dedup"](spark, good, SF), "t")
    want = {i for i, _, c in brute([(i, r.text) for i, r in rows.items()]) if i == c}
    assert one.columns == COLUMNS and {str(r.doc_id) for r in one.collect()} == want

    hidden = materialize(stage["secret scans"](spark, one, SF), "t")
    got = {r.doc_id: r for r in hidden.collect()}
    assert hidden.columns == COLUMNS and {str(i) for i in got} == want
    for i, r in got.items():
        assert r.text == secrets.redacted(rows[i].text) and r.n_chars == len(r.text)
    planted = f"token = {42:08x}beef of the base, and AKIA{7:016d}"
    extra = spark.createDataFrame([(1, planted, "en", "src", 1), (2, "nothing here", "en", "src", 12)], docs.schema)
    shown = {r.doc_id: r.text for r in stage["secret scans"](spark, extra, SF).collect()}
    assert "beef" not in shown[1] and "AKIA" not in shown[1] and shown[2] == "nothing here"

    mixed = materialize(stage["mixing to target weights"](spark, hidden, SF), "t")
    rates, _ = soft_mixing.mix(hidden, marks, ["quality", "toxic"], factors=corpus_pipeline.MIX_FACTORS)
    assert mixed.columns == COLUMNS
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert copies == {r.doc_id: r.copies for r in rates.collect() if r.copies}
    clean = {r.doc_id for r in marks.collect() if r.quality == 1 and r.toxic == 0} & set(got)
    assert len(clean - set(copies)) <= 0.05 * len(clean)

    encoded = stage["SentencePiece encoding"](spark, mixed, SF).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.PIECE_MODEL)
    assert all(r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) and r.lossless for r in encoded)
    assert {r.doc_id for r in encoded} == {r.doc_id for r in mixed.collect()}


@needs_data
def test_queries_with_sql(spark):
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from oracle import compare, duck

    for name, sql in queries.ORACLE.items():
        ok, said = compare(queries.QUERIES[name](spark, SF), duck(SF), sql)
        assert ok, (name, said)
