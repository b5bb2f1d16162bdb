"""Aggregations with R's NA contract (A1-A10, O1-O2).

Everything is a ``groupBy().agg()`` so Spark combines map-side before the shuffle: a family holding a third
of all rows costs one partial row per input partition, not one giant task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.functions.nulls import is_missing, missing_count


def frequency_table(df: DataFrame, col: str, value_name: str = "value", count_name: str = "n") -> DataFrame:
    """``as.data.frame(table(x))``: NA excluded, one row per value, ascending value order (A5)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(value_name))
            .agg(F.count(F.lit(1)).alias(count_name)).orderBy(value_name))


def with_missing_count(df: DataFrame, name: str = "n_missing", cols: Sequence[str] | None = None) -> DataFrame:
    """``mutate(n_missing = rowSums(is.na(.)))`` over all (or the given) columns."""
    return df.withColumn(name, missing_count(list(cols) if cols else df.columns))


def missing_by_group(df: DataFrame, group: str, count_col: str = "n_missing") -> DataFrame:
    """Per group: rows with any missing cell and their total missing cells, largest first."""
    return (df.filter(F.col(count_col) > 0).groupBy(group)
            .agg(F.count(F.lit(1)).alias("n_missing_families"),
                 F.sum(count_col).cast("bigint").alias("total_missing_attributes"))
            .orderBy(F.desc_nulls_last("n_missing_families"), F.asc_nulls_last(group)))


def missing_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Each observed missing/present combination with its frequency (the table behind VIM ``aggr``) (A10)."""
    return (df.groupBy(*[is_missing(c).alias(c) for c in cols])
            .agg(F.count(F.lit(1)).alias("n")))


def missing_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the proportion of missing cells per column (A10, the bar chart of ``aggr``)."""
    return df.agg(*[F.avg(is_missing(c).cast("double")).alias(c) for c in cols])
