"""SparkSession construction and the shared checkpoint / scratch location.

On a cluster the session is created by the platform and ``spark.checkpoint.dir`` names a shared folder;
it is read from the session and never overridden.  Only when it is unset (local tests) do we pick a
private temporary folder.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins at runtime (broadcast only when the *measured* side is
# under the threshold, skew-join splitting, partition coalescing).  All are plain public configs.
_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # size-checked broadcast: the planner only broadcasts a side whose estimated / measured size is below this
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # plan construction only: skip Python call-site capture (several JVM round trips per Column function)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "ecospark", shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.  Only on a local master may it be unset: a private folder is then
    used and removed when Python ends; elsewhere executors could not see it, so that is an error."""
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="ecospark-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


#: Folders that ``materialize`` wrote in this Python process and that are still there.
_written: list[str] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint folder and reading it back.

    Survives executor loss (the files live on the shared store), unlike cached or locally checkpointed data.  The files
    stay until ``drop_materialized``, since later plans read them.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _written.append(path)
    return spark.read.parquet(path)


def drop_materialized(spark: SparkSession, since: int = 0) -> int:
    """Delete what ``materialize`` wrote after the first ``since`` tables, once no plan reads it any more (jobs do this when
    their outputs are written); returns how many folders went."""
    gone = _written[since:]
    for path in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    del _written[since:]
    return len(gone)


def materialized() -> int:
    """Number of tables that ``materialize`` wrote and that were not dropped."""
    return len(_written)
