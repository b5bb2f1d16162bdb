"""Small document tables for the corpus operators: the driver's smallest table, and one of edge cases."""

import os

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])
LONG = " ".join(f"w{i % 977}" for i in range(40_000))
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "one two"), (5, "one two"), (7, "one\x1ftwo\x0bthree " * 30),
        (8, LONG), (9, LONG), (10, "a b c d e f g h"), (None, "no id at all"), (12, "é ñ 日本 😀 ▁x  y"), (13, "ONE TWO"),
        (14, "\n".join(["same line"] * 5)), (15, "x" * 3000)]


def edge_rows():
    return [(i, t, None if k % 3 else "en", "src", None if t is None else len(t)) for k, (i, t) in enumerate(EDGE)]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def clashing(spark):
    """The edge rows with extra columns whose names the operators use inside."""
    df = edge_docs(spark)
    for c in ("n_tokens", "lossless", "own_0", "own_1", "own_2", "_id", "_key", "_copies", "_copy", "_found", "_kept", "_nth", "key", "rep", "size", "shard", "row", "score", "ids", "n", "comp", "label", "rate", "p", "first", "same"):
        df = df.withColumn(c, df.lang)
    return df


def labels(spark, rows=((4, 1, 0), (8, 1, 1), (10, 0, 0), (13, 0, 1), (14, None, 0), (99, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
