import random

from pyspark.sql import functions as F

from conftest import rows
from ecospark.operators import aggregates, reshape, windows


def test_fill_downup_fixture(spark):
    df = spark.createDataFrame([("g", 1, None), ("g", 2, 5), ("g", 3, None), ("g", 4, 7), ("h", 1, None)],
                               "g string, o int, v int")
    out = windows.fill(df, ["v"], ["g"], ["o"], "downup")
    assert rows(out) == [("g", 1, 5), ("g", 2, 5), ("g", 3, 5), ("g", 4, 7), ("h", 1, None)]


def test_fill_chunked_equals_window(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b", None]), i, rnd.choice([None, None, rnd.randint(0, 9)])) for i in range(400)]
    df = spark.createDataFrame(data, "g string, o int, v int")
    for d in ("down", "up", "downup", "updown"):
        a = windows.fill(df, ["v"], ["g"], ["o"], d, chunks=9)
        b = windows.fill(df, ["v"], ["g"], ["o"], d, strategy="window")
        assert rows(a) == rows(b), d
        # never changes a non-NULL cell
        changed = a.join(df.withColumnRenamed("v", "v0"), ["g", "o"]).filter(F.col("v0").isNotNull() & (F.col("v") != F.col("v0")))
        assert changed.count() == 0


def test_first_per_group_and_extremes(spark):
    df = spark.createDataFrame([("k", 2, 1.0), ("k", 1, 3.0), ("j", 5, None)], "k string, o int, x double")
    assert rows(windows.first_per_group(df, ["k"], ["o"])) == [("j", 5, None), ("k", 1, 3.0)]
    ext = windows.with_group_extremes(df, ["k"], mins=["x"])
    assert rows(ext) == [("j", 5, None), ("k", 1, 1.0), ("k", 2, 1.0)]


def test_separate(spark):
    df = spark.createDataFrame([("a;b;c;d;e;f;g;h",), ("a;b",)], "t string")
    out = reshape.separate(df, "t", list("ABCDEFG"), ";")
    assert rows(out) == [("a", "b", None, None, None, None, None), ("a", "b", "c", "d", "e", "f", "g")]


def test_pivot_ranks_fixture(spark):
    cls = spark.createDataFrame([(1, "B", "family", 10), (1, "G", "genus", 11), (1, "O", "order", 12),
                                 (2, "H", "genus", 13)], "taxon_key int, name string, rank string, id int")
    kept = cls.filter(F.col("rank").isin("family", "subfamily", "genus")).drop("id").distinct()
    out = reshape.pivot_fixed(kept, ["taxon_key"], "rank", "name", ["family", "subfamily", "genus"])
    assert rows(out) == [(1, "B", None, "G"), (2, None, None, "H")]


def test_explode_wide_matches_unpivot(spark):
    df = spark.createDataFrame([("c1", 0, 3, None), ("c2", 5, 0, 1)], "cluster string, s1 int, s2 int, s3 int")
    a = reshape.explode_wide(df, ["cluster"], None, "sample", "reads", keep=lambda v: v > 0)
    b = reshape.unpivot_columns(df, ["cluster"], ["s1", "s2", "s3"], "sample", "reads").filter("reads > 0")
    assert rows(a) == rows(b) == [("c1", "s2", 3), ("c2", "s1", 5), ("c2", "s3", 1)]


def test_frequency_and_patterns(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    assert [tuple(r) for r in aggregates.frequency_table(df, "x").collect()] == [("a", 2), ("b", 1)]
    df2 = spark.createDataFrame([(None, None), (None, 1), (1, None), (None, None)], "a int, b int")
    assert rows(aggregates.missing_patterns(df2, ["a", "b"])) == [(False, True, 1), (True, False, 1), (True, True, 2)]
    assert rows(aggregates.missing_share(df2, ["a", "b"])) == [(0.75, 0.75)]


def test_fill_hot_group_partial_sample(spark):
    # one group holds ~2/3 of the rows; 16 chunks sample ~1k of 12k keys, so bounds come from a partial sample
    df = spark.range(0, 12000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("g"),
        ((F.col("id") * 7919) % 12000).alias("o"),
        F.when(F.col("id") % 97 == 0, F.col("id")).alias("v"))
    a = windows.fill(df, ["v"], ["g"], ["o"], "downup", chunks=16)
    b = windows.fill(df, ["v"], ["g"], ["o"], "downup", strategy="window")
    assert rows(a) == rows(b)


def test_ordered_row_numbers_partial_sample(spark):
    from ecospark.sources.delimited import with_row_number
    df = spark.range(0, 30000, 1, 5).select(((F.col("id") * 7919) % 30000).alias("k"))
    got = with_row_number(df, "_row", order_by=["k"]).select("k", "_row")
    assert got.filter(F.col("k") + 1 != F.col("_row")).count() == 0
    assert got.count() == 30000


def test_unpivot_then_pivot_round_trips(spark):
    rnd = random.Random(3)
    data = [(i, *(rnd.choice([None, rnd.random()]) for _ in range(3))) for i in range(60)]
    wide = spark.createDataFrame(data, "k int, a double, b double, c double")
    long = reshape.unpivot_columns(wide, ["k"], ["a", "b", "c"], "name", "value")
    back = reshape.pivot_fixed(long, ["k"], "name", "value", ["a", "b", "c"])
    assert rows(back, "k", "a", "b", "c") == rows(wide, "k", "a", "b", "c")


def test_fill_of_a_hot_group_over_many_chunks(spark):
    df = spark.range(0, 6000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("cold")).when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise(F.lit("hot")).alias("g"),
        ((F.col("id") * 7919) % 6000).alias("o"),
        F.when(F.col("id") % 89 == 0, F.col("id")).alias("v"))
    a = windows.fill(df, ["v"], ["g"], ["o"], "downup", chunks=12)
    b = windows.fill(df, ["v"], ["g"], ["o"], "downup", strategy="window")
    assert rows(a) == rows(b)


def test_explode_wide_of_many_columns(spark):
    cols = [f"s{i}" for i in range(25)]
    df = spark.range(0, 200, 1, 3).select(F.col("id").alias("cluster"),
                                          *[((F.col("id") * (i + 3)) % 4).alias(c) for i, c in enumerate(cols)])
    whole = reshape.explode_wide(df, ["cluster"], cols, "sample", "reads", keep=lambda v: v > 0)
    plain = reshape.unpivot_columns(df, ["cluster"], cols, "sample", "reads").where("reads > 0")
    assert rows(whole) == rows(plain)
    assert whole.count() > 0
