"""Row filters with R's NA contract."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.functions.nulls import any_missing, is_in, not_in


def filter_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """``filter(x %in% values)``."""
    return df.filter(is_in(col, values))


def filter_not_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """``filter(!x %in% values)``: NULL x rows are kept."""
    return df.filter(not_in(col, values))


def drop_na(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """``drop_na(a, b)``; with no subset: complete cases over all columns."""
    return df.filter(~any_missing(list(subset) if subset else df.columns))


def drop_na_except(df: DataFrame, exclude: Sequence[str]) -> DataFrame:
    """``drop_na(-sub_family)``: complete over all columns but ``exclude``, which are kept."""
    checked = [c for c in df.columns if c not in set(exclude)]
    return df.filter(~any_missing(checked)) if checked else df


def keep_any_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``filter_at(vars(cols), any_vars(is.na(.)))``."""
    return df.filter(any_missing(cols))


def keep_flag(df: DataFrame, col: str) -> DataFrame:
    """``filter(flag)``: NULL flags dropped."""
    return df.filter(F.col(col))
