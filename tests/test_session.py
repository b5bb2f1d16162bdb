import os

import pytest

from ecospark.session import checkpoint_dir, drop_materialized, materialize, materialized


def test_checkpoint_dir_is_read_not_replaced(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == configured          # set by the test session; never overridden


def test_materialize_writes_under_checkpoint_dir(spark):
    df = spark.range(0, 100).withColumnRenamed("id", "k")
    out = materialize(df, "t")
    assert out.count() == 100
    assert all(checkpoint_dir(spark) in p for p in out.inputFiles())


def test_tables_go_when_a_job_is_done(spark):
    before = materialized()
    kept = [materialize(spark.range(5), name).inputFiles()[0].removeprefix("file://").removeprefix("file:") for name in ("a", "b")]
    assert materialized() == before + 2 and all(map(os.path.exists, kept))
    assert drop_materialized(spark, before) == 2
    assert materialized() == before and not any(map(os.path.exists, kept))
    assert drop_materialized(spark, before) == 0


def test_a_cluster_needs_the_setting():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        checkpoint_dir(Session())
