"""Lenient numeric parsing (``as.numeric``): junk becomes NULL instead of an ANSI cast error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ecospark.functions.strings import ColumnOrName, _c

# Fixed value: the decimal grammar R's as.numeric accepts for plain numbers (surrounding blanks allowed).
# Spark's own cast also takes suffixes like '1.0d' / '1f', which R rejects, so the text is checked first.
NUMERIC_TEXT = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"


def lenient_double(c: ColumnOrName) -> Column:
    """String (or number) -> DOUBLE; non-numeric text -> NULL.  NaN/Inf never appear (R's NA contract)."""
    return _number_below(_c(c).cast("string"), float("inf"))  # '1e999' reads as infinite


def _number_below(s: Column, limit: float) -> Column:
    """A number's text -> DOUBLE where it is nearer to zero than ``limit``.  The grammar is tried once a cell: under a
    second condition it would be run again for each use of the value."""
    value = s.try_cast("double")
    return F.when(s.rlike(NUMERIC_TEXT) & (F.abs(value) < F.lit(limit)), value)


def count_cell(c: ColumnOrName) -> Column:
    """A cell of a count matrix -> BIGINT: ``12``, ``12.0``, ``1e+05`` and ``"12"`` are counts (fractions are cut
    off); blank, ``NA`` and other text are NULL."""
    s = F.btrim(_c(c).cast("string"), F.lit('" '))
    # a cast that fails costs an exception, and no text with a dot or a letter is a whole number to it
    whole = F.when(~s.rlike("[.A-Za-z]"), s.try_cast("bigint"))
    return F.coalesce(whole, _number_below(s, 9.0e18).cast("bigint"))


def european_double(c: ColumnOrName) -> Column:
    """``read_csv2`` number: '.' groups thousands, ',' is the decimal mark ('1.234,5' -> 1234.5)."""
    s = _c(c).cast("string")
    return lenient_double(F.replace(F.replace(s, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
