"""Column types of text scans, found over the whole file.

A cell is logical, integer, double, date, text or missing.  The kinds of a column's cells are joined by one aggregate
over all rows - no sampled prefix, so a single late odd cell makes the column text - and the column is then cast once.
Missing cells are neutral; a column without any other cell is logical, as the original readers have it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ecospark.functions.numeric import european_double, lenient_double

LOGICAL, INTEGER, DOUBLE, DATE, TEXT = (1 << k for k in range(5))
TRUE, FALSE = ("TRUE", "T", "True", "true"), ("FALSE", "F", "False", "false")
_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


@dataclass(frozen=True)
class Grammar:
    """How numbers are written.  ``zeros`` says whether digits after a leading zero are a number."""

    double: str = r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
    to_double: Callable[[Column], Column] = lenient_double
    zeros: bool = False

    @property
    def integer(self) -> str:
        return r"^[-+]?[0-9]{1,18}$" if self.zeros else r"^[-+]?(0|[1-9][0-9]{0,17})$"


PLAIN, LEADING_ZEROS = Grammar(), Grammar(zeros=True)
#: ',' is the decimal mark and '.' groups thousands.
EUROPEAN = Grammar(r"^[-+]?([0-9]{1,3}(\.[0-9]{3})+|[0-9]+)(,[0-9]*)?([eE][-+]?[0-9]+)?$", european_double)


def kind(cell: Column, grammar: Grammar = PLAIN) -> Column:
    """The kind of a cell as a bit, 0 for missing and blank cells."""
    text = F.btrim(cell)
    odd_zero = F.lit(False) if grammar.zeros else text.rlike(r"^[-+]?0[0-9]")
    return F.when(text.isNull() | (text == ""), 0).when(text.isin(*TRUE, *FALSE), LOGICAL).when(text.rlike(grammar.integer), INTEGER) \
        .when(text.rlike(grammar.double) & ~odd_zero & grammar.to_double(text).isNotNull(), DOUBLE) \
        .when(text.rlike(_ISO_DATE) & text.try_cast("date").isNotNull(), DATE).otherwise(TEXT)


def joined(bits: int) -> str:
    """The type that holds all kinds of ``bits``."""
    return {0: "boolean", LOGICAL: "boolean", INTEGER: "bigint", DOUBLE: "double", INTEGER | DOUBLE: "double", DATE: "date"}.get(bits, "string")


def infer(df: DataFrame, grammar: Grammar = PLAIN) -> dict[str, str]:
    """The type of every string column, by one aggregate over the whole frame."""
    names = [c for c, t in df.dtypes if t == "string"]
    if not names:
        return {}
    found = df.agg(*[F.bit_or(kind(F.col(f"`{c}`"), grammar)).alias(f"k{i}") for i, c in enumerate(names)]).first()
    return {c: joined(found[i] or 0) for i, c in enumerate(names)}


def cast(cell: Column, to: str, grammar: Grammar = PLAIN) -> Column:
    """A text cell as ``to``; blank cells of a column that is no text are missing."""
    text = F.btrim(cell)
    if to == "boolean":
        return F.when(text.isin(*TRUE), True).when(text.isin(*FALSE), False)
    if to == "double":
        return grammar.to_double(text)
    return cell if to == "string" else text.try_cast(to)


def typed(df: DataFrame, grammar: Grammar = PLAIN) -> DataFrame:
    """``df`` with its string columns cast to the types that their cells have."""
    types = infer(df, grammar)
    return df.select(*[cast(F.col(f"`{c}`"), types[c], grammar).alias(c) if c in types else F.col(f"`{c}`") for c in df.columns])
