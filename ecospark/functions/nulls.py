"""R missing-value semantics as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecospark.functions.strings import ColumnOrName, _c


def is_in(c: ColumnOrName, values: Iterable) -> Column:
    """``x %in% values``: never NULL; a NULL x is TRUE only when the set holds NA."""
    vals = list(values)
    col = _c(c)
    non_null = [v for v in vals if v is not None]
    hit = F.coalesce(col.isin(non_null), F.lit(False)) if non_null else F.lit(False)
    if len(non_null) != len(vals):
        hit = hit | col.isNull()
    return hit


def not_in(c: ColumnOrName, values: Iterable) -> Column:
    """``!x %in% values``: keeps NULL x unless NA is in the set."""
    return ~is_in(c, values)


def is_missing(c: ColumnOrName) -> Column:
    """``is.na(x)``: NULL, or NaN in a floating-point column (X14).  Never NULL.  The type test is constant, so other
    columns pay nothing for it."""
    col = _c(c)
    nan = F.when(F.typeof(col).isin("double", "float"), col.cast("string") == F.lit("NaN"))
    return col.isNull() | F.coalesce(nan, F.lit(False))


def fold_missing(df: DataFrame) -> DataFrame:
    """NaN and infinite values of floating-point columns become NULL: done once, where data comes in."""
    return df.select(*[F.when(F.abs(F.col(f"`{c}`")) < F.lit(float("inf")), F.col(f"`{c}`")).alias(c)
                       if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


def any_missing(cols: Iterable[ColumnOrName]) -> Column:
    """TRUE when any of the columns is missing."""
    return reduce(or_, [is_missing(c) for c in cols])


def missing_count(cols: Iterable[ColumnOrName]) -> Column:
    """``rowSums(is.na(.))`` over the given columns, INT."""
    return reduce(lambda a, b: a + b, [is_missing(c).cast("int") for c in cols])


def distinct_with_null(c: ColumnOrName) -> Column:
    """``n_distinct(x)`` / ``length(unique(x))``: NULL counts as one value (A2); BIGINT.

    Distinct non-NULL values plus one if the group has a NULL.  Keeps the distinct key a primitive column
    (compact rows in the Expand / shuffle of the distinct aggregation) instead of wrapping it in a struct.
    """
    col = _c(c)
    return (F.count_distinct(col) + F.max(col.isNull().cast("long"))).alias("n_distinct")
