"""A folder of saved tables, as a list of results of which some failed.

Each file is a small table - one classification, one lookup - that one task reads whole.  A file that cannot be read
costs its own rows only: it gives one row with the reason, and the others are read on.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

#: Bytes of a file that is read whole; a greater one counts as lost and says so.
MOST_BYTES = 256 << 20


def read_table_list(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """``file``, ``error`` and the columns of ``schema`` (by name; a column that a file lacks is NULL) for every row of
    the parquet files below ``path``.  Of a file that cannot be read there is one row, whose ``error`` names the reason;
    elsewhere it is NULL."""
    fields = (_parse_datatype_string(schema) if isinstance(schema, str) else schema).fields
    out = StructType([StructField("file", StringType()), StructField("error", StringType()), *fields])
    arrow = to_arrow_schema(out)

    def row(file: str, error: str) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": file, "error": error}], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size, content in zip(*(batch.column(c) for c in ("path", "length", "content"))):
                file = file.as_py()
                if size.as_py() > MOST_BYTES:
                    yield row(file, f"{size} bytes, more than {MOST_BYTES}")
                    continue
                try:
                    table = pq.read_table(io.BytesIO(content.as_buffer()))
                    parts = [pa.array([file] * table.num_rows, pa.string()), pa.nulls(table.num_rows, pa.string())]
                    parts += [table[f.name].combine_chunks().cast(f.type) if f.name in table.column_names else pa.nulls(table.num_rows, f.type)
                              for f in list(arrow)[2:]]
                    found = pa.RecordBatch.from_arrays([p.combine_chunks() if isinstance(p, pa.ChunkedArray) else p for p in parts], schema=arrow)
                except (pa.ArrowException, OSError, ValueError) as e:
                    yield row(file, f"{type(e).__name__}: {e}"[:500])
                    continue
                yield from [found.slice(at, 10_000) for at in range(0, found.num_rows, 10_000)]

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    small = F.when(F.col("length") <= MOST_BYTES, F.col("content"))
    return files.select("path", "length", small.alias("content")).mapInArrow(run, out)
