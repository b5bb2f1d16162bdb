"""Order-preserving chunks for distributed scans (fills, consecutive row numbers).

A scan that must see rows in order is split into chunks that are contiguous in (group, order) and of bounded size;
each chunk is processed on its own and only small per-chunk summaries cross chunk borders.

The rows are range-partitioned and written once to the shared folder with the number of their partition.  That fixes
the chunk of a row for every branch of the plan and for every retry after a lost executor; a range exchange inside the
plan would not, since each pruned branch samples its own bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecospark.session import materialize


def sort_key_columns(group_by: Sequence[str], order_by: Sequence[str]) -> list[Column]:
    """Flat list of columns that sorts like ``group_by ASC, order_by ASC NULLS LAST``."""
    cols = [F.col(g) for g in group_by]
    for c in order_by:
        cols += [F.col(c).isNull(), F.col(c)]
    return cols


def with_chunks(df: DataFrame, key: Sequence[Column], n_chunks: int, name: str = "__chunk") -> DataFrame:
    """``df``, written to the shared folder, plus an INT chunk column that is monotone in ``key``."""
    names = [f"__k{i}" for i in range(len(key))]
    ranged = df.withColumns(dict(zip(names, key))).repartitionByRange(n_chunks, *names) \
        .withColumn(name, F.spark_partition_id())
    return materialize(ranged.drop(*names), "chunks")
