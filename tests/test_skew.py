"""A hot key (half of all rows) and the NULL-key group must not stay in one task: with sort-merge joins
forced, AQE splits the skewed partitions of the split full join, and the result equals the native join."""

from pyspark.sql import functions as F

from conftest import rows
from ecospark.operators import joins


def test_split_full_join_is_skew_splittable(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        big = spark.range(0, 40000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None))
            .otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("a"))
        small = spark.range(0, 600, 1, 4).select(
            F.when(F.col("id") % 50 != 0, F.col("id")).alias("k"), (F.col("id") * 2).alias("b"))
        out = joins.full_join(big, small, "k")
        out.collect()                        # runs this DataFrame's own adaptive plan to its final form
        got = rows(out)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan
        assert "isSkewJoin=true" in plan or "skew=true" in plan, plan
        assert got == rows(joins.full_join(big, small, "k", strategy="native"))
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
