import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from conftest import rows
from ecospark.operators import joins

S = "h string, f string, v int"


@pytest.mark.parametrize("strategy", ["split", "native"])
def test_null_safe_full_join(spark, strategy):
    x = spark.createDataFrame([(None, "f1", 1), ("H", "f2", 2), ("H", None, 3)], S)
    y = spark.createDataFrame([(None, "f1", 9), ("H", None, 8), ("Z", "z", 7)], "h string, f string, w int")
    out = joins.full_join(x, y, ["h", "f"], strategy=strategy)
    assert out.columns == ["h", "f", "v", "w"]
    assert rows(out) == [(None, "f1", 1, 9), ("H", None, 3, 8), ("H", "f2", 2, None), ("Z", "z", None, 7)]
    plain = x.join(y, ["h", "f"], "full")
    assert plain.count() == 6


def test_value_in_key_full_join(spark):
    x = spark.createDataFrame([("A", "f1", None), ("A", "f2", "Predator")], "h string, f string, n string")
    y = spark.createDataFrame([("A", "f1", None), ("A", "f2", "Saprophagous")], "h string, f string, n string")
    out = joins.full_join(x, y, ["h", "f", "n"])
    assert rows(out) == [("A", "f1", None), ("A", "f2", "Predator"), ("A", "f2", "Saprophagous")]


def test_left_join_null_subfamily_and_fanout(spark):
    occ = spark.createDataFrame([("Braconidae", None)], "family string, subfamily string")
    lk = spark.createDataFrame([("Braconidae", None, "P"), ("Braconidae", "Alysiinae", "Q")],
                               "family string, subfamily string, niche string")
    assert rows(joins.left_join(occ, lk, ["family", "subfamily"]), "niche") == [("P",)]
    occ2 = spark.createDataFrame([("Carabidae", "c1")], "family string, cluster string")
    lk2 = spark.createDataFrame([("Carabidae", None, "P"), ("Carabidae", "x", "Q")],
                                "family string, subfamily string, niche string")
    assert joins.left_join(occ2, lk2, ["family"]).count() == 2


def test_suffixes_on_clash(spark):
    x = spark.createDataFrame([(1, "a")], "k int, v string")
    y = spark.createDataFrame([(1, "b")], "k int, v string")
    assert joins.left_join(x, y, "k").columns == ["k", "v_x", "v_y"]


def test_patch(spark):
    x = spark.createDataFrame([("a", None), ("b", 2), (None, None)], "k string, v int")
    y = spark.createDataFrame([("a", 1), ("b", 9), (None, 5), ("z", 7)], "k string, v int")
    out = joins.patch(x, y, ["k"])
    assert rows(out) == [(None, 5), ("a", 1), ("b", 2)]
    # idempotent, never changes a non-NULL cell
    assert rows(joins.patch(out, y, ["k"])) == rows(out)


def test_patch_duplicate_keys_fail_lazily(spark):
    x = spark.createDataFrame([("a", None)], "k string, v int")
    y = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    out = joins.patch(x, y, ["k"])
    for action in (lambda: out.collect(), lambda: out.count(), lambda: out.select("k").collect()):
        with pytest.raises((PySparkException, Py4JJavaError)):
            action()


def test_patch_rejects_extra_columns(spark):
    x = spark.createDataFrame([("a", 1)], "k string, v int")
    y = spark.createDataFrame([("a", 1, 2)], "k string, v int, w int")
    with pytest.raises(ValueError):
        joins.patch(x, y, ["k"])


def test_mark_join(spark):
    x = spark.createDataFrame([("f1",), ("f9",), (None,)], "f string")
    s1 = spark.createDataFrame([("f1",)], "f string")
    s2 = spark.createDataFrame([("f1",), (None,)], "f string")
    assert rows(joins.mark_join(x, s1, "f", "in_set")) == [(None, False), ("f1", True), ("f9", False)]
    assert rows(joins.mark_join(x, s2, "f", "in_set")) == [(None, True), ("f1", True), ("f9", False)]


def test_natural_join_keys(spark):
    a = spark.createDataFrame([(1, "x", 1.0)], "k int, s string, a double")
    b = spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "k int, s string, b double")
    assert joins.common_keys(a, b) == ["k", "s"]
    assert rows(joins.natural_join(a, b)) == [(1, "x", 1.0, 2.0), (2, "y", None, 3.0)]


def test_full_join_row_count_property(spark):
    a = spark.range(0, 200).select((F.col("id") % 37).alias("k"), F.col("id").alias("a"))
    b = spark.range(0, 50).select(F.when(F.col("id") % 5 != 0, F.col("id")).alias("k"), F.col("id").alias("b"))
    out = joins.full_join(a, b, "k")
    assert out.count() >= max(a.count(), b.count())
    assert rows(out) == rows(joins.full_join(a, b, "k", strategy="native"))


def test_null_key_report(spark):
    x = spark.createDataFrame([(None, "f1", 1), ("H", "f2", 2), (None, None, 3), (None, None, 4)], S)
    y = spark.createDataFrame([(None, None, 9), (None, None, 8), ("Z", "z", 7)], "h string, f string, w int")
    r = joins.null_key_report(x, y, ["h", "f"]).first()
    assert (r.left_null_key_rows, r.right_null_key_rows, r.null_key_pairs, r.left_rows) == (2, 2, 4, 4)
    assert joins.full_join(x, y, ["h", "f"]).filter("h IS NULL AND f IS NULL").count() == 4


def test_null_key_report_partial_nulls(spark):
    x = spark.createDataFrame([(None, "f1", 1), (None, None, 2)], S)
    y = spark.createDataFrame([(None, "f1", 9)], "h string, f string, w int")
    r = joins.null_key_report(x, y, ["h", "f"]).first()
    # only rows whose keys are all NULL count; (NULL, f1) is a partial NULL key
    assert (r.left_null_key_rows, r.right_null_key_rows, r.null_key_pairs) == (1, 0, 0)


def test_marked_full_join_keeps_lone_rows_out_of_the_left_join(spark, monkeypatch):
    """Same rows as the split join; rows of the right side without a partner, here a hot missing key, never meet the left."""
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("l", 4)], "k string, v int")
    right = spark.createDataFrame([("a", 7, 1), ("a", 8, 2), ("b", 9, 3), ("r", 5, 4)] + [(None, n, n) for n in range(50)], "k string, w int, x int")
    both = left.unionByName(spark.createDataFrame([(None, 6)], "k string, v int"))
    written = {}
    monkeypatch.setattr(joins, "materialize", lambda df, name: written.setdefault(name, df))
    for l in (left, both):
        written.clear()
        assert rows(joins.natural_join(l, right, strategy="marked")) == rows(joins.natural_join(l, right))
        assert written["partners"].count() == (3 if l is left else 53)


def test_occurrences_join_counts_with_partners_only(spark, monkeypatch):
    from ecospark.plans import occurrences as occ
    names = []
    monkeypatch.setattr(joins, "materialize", lambda df, name: names.append(name) or df, raising=False)
    counts = spark.createDataFrame([("c1", "P1", 3)], "cluster string, sample_id_ngi string, read_count int")
    meta = spark.createDataFrame([("P1", 1), (None, 2), (None, 3)], "sample_id_ngi string, week_year int")
    assert rows(occ.occurrences(counts, meta), "cluster", "week_year") == [(None, 2), (None, 3), ("c1", 1)]
    assert names == ["marked", "partners"]
