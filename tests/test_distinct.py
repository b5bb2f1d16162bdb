"""Distinct counts by bit words against counting in Python, and their plans."""

import random

import pytest

from conftest import rows
from ecospark.operators import distinct_counts

import __spark_entry__ as entry


def counted(data):
    groups = {}
    for g, a, b, n in data:
        groups.setdefault(g, []).append((a, b, n))
    return sorted(((g, len({a for a, _, _ in r}), len({b for _, b, _ in r}), sum(n for _, _, n in r)) for g, r in groups.items()),
                  key=lambda t: tuple((x is not None, x) for x in t))


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
def test_counts_equal_python(spark, kind):
    rnd = random.Random(5)
    as_kind = str if kind == "string" else int
    data = [(rnd.choice(["hot", "hot", "hot", "x", "y", None]), rnd.choice([None, *map(as_kind, range(-130, 130, 3))]),
             rnd.choice([None, "", "t1", "t2", "t3"]), rnd.randint(0, 9)) for _ in range(3000)]
    data += [("one", None, None, 1), ("edge", as_kind(2 ** 31 - 1), "t", 2), ("edge", as_kind(-2 ** 31), "t", 2), ("edge", as_kind(0), "t", 0)]
    df = spark.createDataFrame(data, f"g string, a {kind}, b string, n long")
    got = distinct_counts(df.repartition(7), ["g"], {"n_a": "a", "n_b": "b"}, {"total": "n"})
    assert got.columns == ["g", "n_a", "n_b", "total"]
    assert rows(got) == counted(data)
    assert rows(distinct_counts(df, ["g"], {"n_a": "a"})) == [r[:2] for r in counted(data)]


def test_long_ends_and_several_keys(spark):
    ends = [2 ** 63 - 1, -2 ** 63, -1, 0, 63, 64]
    df = spark.createDataFrame([(k, None, v) for k in (1, 2) for v in ends * 2], "k int, `a b` string, v long")
    assert rows(distinct_counts(df, ["k", "a b"], {"n": "v"})) == [(1, None, 6), (2, None, 6)]
    assert distinct_counts(df.limit(0), ["k"], {"n": "v", "m": "k"}, {"s": "v"}).collect() == []


@pytest.mark.parametrize("name", ["family_reads", "niche_richness"])
def test_no_expand_and_combined_before_the_shuffle(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "gid" not in plan and "partial_bit_or" in plan  # gid: the copy number of an Expand for distinct counts


def test_occurrence_attributes_combines_words(spark):
    """A task's table holds a word of clusters and not each cluster: its memory stays small."""
    plan = entry.queries()["occurrence_attributes"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "count(distinct" not in plan
