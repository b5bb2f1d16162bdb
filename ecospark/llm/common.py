"""Helpers shared by the corpus operators: scratch tables in the shared folder, words, checks of columns."""

from __future__ import annotations

import ctypes
import gc
import itertools
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Characters that end a word; everything else belongs to one.
SPACE = "\\x20\\x09-\\x0D"


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a session on a local master may lack the setting (tests); elsewhere a private folder would not be seen
    by the executors, so its absence is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ecospark-llm-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_held: dict[str, object] = {}


def worker_cache(key: str, make):
    """What an operator remembers in a Python worker.  Workers are used by one operator after the other; only the one
    at work keeps what it remembers, so that a worker's memory does not grow with the operators it has served."""
    if key not in _held:
        if _held:
            _held.clear()
            _returned()
        _held[key] = make()
    return _held[key]


def _returned() -> None:
    """Give freed memory back to the system: Spark counts what a worker holds, used or not."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a table that ``materialize`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    jvm, top = spark._jvm, scratch(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(jvm.org.apache.hadoop.fs.Path(top).toUri().getPath() + "/"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions_for(source: DataFrame, growth: float = 1.0, target: int = 64 << 20) -> int:
    """Number of partitions for ``growth`` times the bytes of ``source``: ``target`` bytes each, and not fewer than
    the session's shuffle partitions."""
    size = int(str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0  # rows without files have no size
    return max(int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(known * growth) // target))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare_names(df: DataFrame, n: int) -> list[str]:
    """Column names that ``df`` does not have, whatever its letters' case."""
    taken = {c.lower() for c in df.columns}
    return list(itertools.islice((c for k in itertools.count() if (c := f"own_{k}") not in taken), n))


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (long) and ``text`` (a null text is empty) of a document table; other columns are left out, so
    that no name of theirs can clash."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def arrow_map(df: DataFrame, per_batch, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` where ``per_batch(batch)`` returns or yields record batches."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from per_batch(batch)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str | int, limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the bytes of ``column`` in a part stay near ``limit`` (one long text may exceed it)."""
    ends = batch.column(column)
    start = taken = 0
    for i, n in enumerate(pa.compute.binary_length(ends).to_pylist()):
        if taken and taken + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, taken = i, 0
        taken += n or 0
    yield batch.slice(start)
