"""Structured Streaming: landed wide count files -> long (cluster, sample, reads) parquet table."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ecospark.operators.reshape import explode_wide
from ecospark.session import checkpoint_dir


def ingest_counts(spark: SparkSession, source_dir: str, samples: list[str], sink_dir: str,
                  cluster: str = "cluster", sep: str = "\t", name: str = "counts",
                  available_now: bool = True) -> StreamingQuery:
    """Start (and with ``available_now`` run to completion) the incremental wide-to-long ingestion.

    ``samples`` fixes the schema of the count files (a stream needs a declared schema).
    """
    schema = StructType([StructField(cluster, StringType())] + [StructField(s, LongType()) for s in samples])
    wide = (spark.readStream.schema(schema).option("sep", sep).option("header", True).option("nullValue", "NA")
            .csv(source_dir))
    long = explode_wide(wide, [cluster], samples, "sample", "reads", keep=lambda v: v > 0)
    writer = (long.writeStream.format("parquet").option("path", sink_dir)
              .option("checkpointLocation", f"{checkpoint_dir(spark).rstrip('/')}/stream-{name}")
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
