"""Row binding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def bind_rows(*dfs: DataFrame) -> DataFrame:
    """``bind_rows(a, b, ...)``: union by column name; columns absent from a frame are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
