"""Ordered rule tables turned into one ``CASE WHEN`` expression.

A rule table is data: a list evaluated top to bottom, first match wins, exactly like ``case_when``.
The resulting expression is a single codegen'd projection; no join, no UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ecospark.functions.strings import ColumnOrName, _c


def first_match(rules: Sequence[tuple[Column, object]], default: Column | None = None) -> Column:
    """``case_when(cond1 ~ v1, cond2 ~ v2, ..., TRUE ~ default)``; NULL condition = not matched."""
    if not rules:
        return default if default is not None else F.lit(None)
    expr = None
    for cond, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(default) if default is not None else expr


def recode(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """``recode(x, a = "b", ...)``: listed values replaced, everything else (incl. NULL) unchanged."""
    col = _c(c)
    return first_match([(col == F.lit(k), v) for k, v in mapping.items()], default=col)


def threshold_fill(target: ColumnOrName, rules: Sequence[tuple[Sequence[tuple[str, float]], str]],
                   strict: bool = True) -> Column:
    """Fill a missing category from score columns.

    ``rules`` = [([(score_col, threshold), ...], value), ...]; a rule fires when the target is NULL and
    every listed score exceeds its threshold.  Non-missing targets are never changed.
    """
    t = _c(target)
    compiled = []
    for conds, value in rules:
        tests = [(F.col(s) > F.lit(th)) if strict else (F.col(s) >= F.lit(th)) for s, th in conds]
        compiled.append((t.isNull() & reduce(and_, tests), value))
    return first_match(compiled, default=t)


def override(target: ColumnOrName, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Unconditional override keyed on other columns (X11): [(column, equals_value, new_value), ...]."""
    t = _c(target)
    return first_match([(F.col(col) == F.lit(val), new) for col, val, new in rules], default=t)


def regex_category(c: ColumnOrName, rules: Sequence[tuple[str, str]]) -> Column:
    """Regex -> category, first match wins, no default (NULL when nothing matches)."""
    col = _c(c)
    return first_match([(col.rlike(p), v) for p, v in rules])


def as_level(c: ColumnOrName, levels: Sequence[str]) -> Column:
    """``factor(x, levels = ...)``: value kept only when it is a level, otherwise NULL (row kept)."""
    col = _c(c)
    return F.when(col.isin(list(levels)), col)


def level_index(c: ColumnOrName, levels: Sequence[str]) -> Column:
    """1-based level position for ordering factors; NULL for non-levels."""
    arr = F.array(*[F.lit(v) for v in levels])
    return F.nullif(F.array_position(arr, _c(c)), F.lit(0)).cast("int")
