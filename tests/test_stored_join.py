"""A table handed off in buckets joins without a shuffle of its own, with missing and hot keys."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ecospark.operators import full_join, join, join_stored
from ecospark.sources import drop_handoff, handoff_bucketed

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture
def shuffled(spark):
    old = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sides(spark, n=4000):
    big = spark.range(0, n, 1, 5).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.concat(F.lit("1:k"), F.col("id") % 300)).otherwise("hot").alias("k"),
        (F.col("id") % 2).cast("double").alias("v"), F.col("id").alias("a"))
    small = spark.createDataFrame([(None, 0.0, "n0"), (None, None, "nn"), ("hot", -0.0, "h"), ("hot", 1.0, "h1"), ("1:k1", 1.0, "x"),
                                   ("gone", 1.0, "y"), ("gone", 1.0, "y")], "k string, v double, b string")
    return big, small


@pytest.mark.parametrize("how", ["left", "inner", "full"])
def test_equals_the_plain_join_without_a_shuffle_of_the_stored_side(shuffled, how):
    big, small = sides(shuffled)
    stored = handoff_bucketed(big, ["k", "v"], 4)
    out = join_stored(small, stored, how)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan  # the other side
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    assert rows(out, "k", "v", "b", "a") == rows(join(small, big, ["k", "v"], how), "k", "v", "b", "a")
    again = join_stored(out.select("k", "v", F.col("b").alias("b2")).distinct(), stored, "inner")
    assert again.count() == rows(join(out.select("k", "v").distinct(), big, ["k", "v"])).__len__()  # joined a second time
    drop_handoff(stored)


def test_hot_keys_are_cut(shuffled):
    big, small = sides(shuffled)
    stored = handoff_bucketed(big, ["k"], 8)
    of = {o for o, _ in stored.parts}
    assert of == {"=-", "=3:hot"} and all(sum(o == x for o, _ in stored.parts) == 3 for x in of)
    per_part = stored.table.groupBy("__stored_key").count().agg(F.max("count")).first()[0]
    assert per_part <= 4000 // 8
    left = small.select("k", "b")
    assert rows(join_stored(left, stored, "full"), "k", "b", "a") == rows(full_join(left, big, ["k"]), "k", "b", "a")


def test_key_texts_keep_lists_apart(shuffled):
    data = [("a", "b"), ("ab", ""), ("", "ab"), ("1:a", None), (None, "1:a"), (None, None), ("", None), (None, ""), ("-", None), ("a1:", "b")]
    df = shuffled.createDataFrame(data, "x string, y string").withColumn("n", F.monotonically_increasing_id())
    stored = handoff_bucketed(df, ["x", "y"], 3)
    got = join_stored(df.withColumnRenamed("n", "m"), stored, "full")
    assert got.where("n <=> m").count() == got.count() == len(data)


def test_empty_clashing_and_dropped(shuffled):
    big, small = sides(shuffled, 30)
    none = handoff_bucketed(big.limit(0), ["k"])
    assert join_stored(small.select("k", "b"), none, "left").count() == 7 and join_stored(small.select("k", "b"), none, "inner").count() == 0
    stored = handoff_bucketed(big, ["k"])
    with pytest.raises(ValueError, match="both sides"):
        join_stored(small, stored)
    with pytest.raises(ValueError, match="join type"):
        join_stored(small, stored, "anti")
    file = stored.table.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    name = os.path.basename(os.path.dirname(file))
    assert os.path.exists(file) and shuffled.catalog.tableExists(name)
    drop_handoff(stored)
    assert not os.path.exists(file) and not shuffled.catalog.tableExists(name)
