"""Wide <-> long reshaping and string splitting into columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecospark.functions.strings import nth_piece


def unpivot_columns(df: DataFrame, ids: Sequence[str], cols: Sequence[str], names_to: str = "name",
                    values_to: str = "value", value_type: str | None = None) -> DataFrame:
    """``pivot_longer(cols, names_to, values_to)`` for a handful of columns (R1, R2); NULL values kept.

    Values are cast to one type first (``unpivot`` rejects mixed types).
    """
    cols = list(cols)
    if value_type is None:
        types = {t for c, t in df.dtypes if c in cols}
        value_type = types.pop() if len(types) == 1 else "string"
    base = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return base.unpivot(list(ids), cols, names_to, values_to)


def explode_wide(df: DataFrame, ids: Sequence[str], cols: Sequence[str] | None = None, names_to: str = "name",
                 values_to: str = "value", keep: Callable[[Column], Column] | None = None,
                 value_type: str | None = None, rename: Callable[[str], str] | None = None) -> DataFrame:
    """Wide matrix with any number of value columns -> long.

    The cells of a row become one array, ``keep`` is applied to it *before* the explode, so zero counts never
    become rows, and the names come from one constant array by position.  One scan, whatever the width.
    ``rename`` rewrites the column names once, on the driver, instead of once per long row.
    """
    ids = list(ids)
    cols = [c for c in df.columns if c not in ids] if cols is None else list(cols)
    vt = value_type or dict(df.dtypes)[cols[0]]
    quoted = ", ".join("`" + c.replace("`", "``") + "`" for c in cols)
    return explode_cells(df, [F.col(c) for c in ids], F.expr(f"array({quoted})").cast(f"array<{vt}>"),
                         [(rename or str)(c) for c in cols], names_to, values_to, keep)


def explode_cells(df: DataFrame, ids: Sequence[Column], cells: Column, names: Sequence[str] | Sequence[Sequence[str]], names_to: str,
                  values_to: str, keep: Callable[[Column], Column] | None = None, head: Column | None = None, placed: bool = False) -> DataFrame:
    """``ids`` plus one row for each kept element of the array ``cells``, named by its position in ``names``; with
    ``head``, in the list of ``names`` that it numbers.  With ``placed`` the elements are structs of a position (from
    zero) and a cell, for matrices whose empty cells are left out.

    Cells are unpacked and filtered in one generated loop, with no call for a cell.  The names travel as one string
    literal a list that the optimizer folds into a constant array, so the plan does not grow with their number.  A cell
    beyond the last name has a NULL name.
    """
    lists = [names] if head is None else names
    sep = next(chr(c) for c in range(1, 32) if not any(chr(c) in n for names in lists for n in names))
    labels = [F.split(F.lit(sep.join(names)), re.escape(sep)) for names in lists]
    place = [] if len(labels) == 1 else [head.alias("__list")]
    # what a row has once is computed below the explode; beside it, it would be computed for every cell
    df = df.select(*ids, *place, cells.alias("__cells"))
    each = F.inline if placed else F.posexplode
    long = df.select(*[F.col(f"`{c}`") for c in df.columns[:-1]], each("__cells").alias("__at", "__cell"))
    if keep is not None:
        long = long.where(keep(F.col("__cell")))
    name = F.try_element_at(labels[0], F.col("__at") + 1)
    for k, label in enumerate(labels[1:], start=1):
        name = F.when(F.col("__list") == k, F.try_element_at(label, F.col("__at") + 1)).otherwise(name)
    kept = [c for c in long.columns if c not in ("__list", "__at", "__cell")]
    return long.select(*[F.col(f"`{c}`") for c in kept], name.alias(names_to), F.col("__cell").alias(values_to))


def pivot_fixed(df: DataFrame, keys: Sequence[str], names_from: str, values_from: str,
                values: Sequence[str]) -> DataFrame:
    """``pivot_wider(names_from, values_from)`` with the name set given up front.

    Listing the values avoids Spark's extra distinct job; absent names give NULL columns.  Each
    (key, name) cell is expected to be unique; ``max`` keeps the result deterministic if it is not.
    """
    return df.groupBy(*keys).pivot(names_from, list(values)).agg(F.max(values_from))


def separate(df: DataFrame, col: str, into: Sequence[str], sep_regex: str, remove: bool = True) -> DataFrame:
    """``separate(col, into, sep)``: extra pieces dropped, missing pieces NULL."""
    pieces = F.split(F.col(col), sep_regex)
    out = []
    for c in df.columns:
        if c == col:
            if not remove:
                out.append(F.col(c))
            out.extend(F.try_element_at(pieces, F.lit(i + 1)).alias(n) for i, n in enumerate(into))
        else:
            out.append(F.col(c))
    return df.select(*out)


__all__ = ["unpivot_columns", "explode_wide", "explode_cells", "pivot_fixed", "separate", "nth_piece"]
