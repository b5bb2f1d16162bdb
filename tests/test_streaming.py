import os
import tempfile

from conftest import rows
from ecospark.streaming import ingest_counts


def test_ingest_counts_incremental(spark):
    base = tempfile.mkdtemp(prefix="ecospark-stream-")
    src, sink = os.path.join(base, "in"), os.path.join(base, "out")
    os.makedirs(src)
    with open(os.path.join(src, "a.tsv"), "w") as f:
        f.write("cluster\ts1\ts2\nc1\t0\t3\nc2\t5\tNA\n")
    q = ingest_counts(spark, src, ["s1", "s2"], sink, name="t1")
    q.awaitTermination(120)
    assert rows(spark.read.parquet(sink)) == [("c1", "s2", 3), ("c2", "s1", 5)]
    # a second landed file is picked up by the next run, earlier files are not re-read
    with open(os.path.join(src, "b.tsv"), "w") as f:
        f.write("cluster\ts1\ts2\nc3\t1\t1\n")
    q = ingest_counts(spark, src, ["s1", "s2"], sink, name="t1")
    q.awaitTermination(120)
    assert rows(spark.read.parquet(sink)) == [("c1", "s2", 3), ("c2", "s1", 5), ("c3", "s1", 1), ("c3", "s2", 1)]
