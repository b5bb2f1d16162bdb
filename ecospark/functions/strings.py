"""String column expressions with R/stringr semantics, all JVM-side (no Python UDF).

stringr differences that matter: ``str_replace`` / ``str_remove`` act on the *first* match only, ``str_extract``
returns NA (not '') when nothing matches, ``str_trim`` strips all Unicode white space, and a split piece that
does not exist is NA.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_all(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """``str_replace_all``: every regex match replaced."""
    return F.regexp_replace(_c(c), pattern, _java_literal_replacement(replacement))


def replace_first(c: ColumnOrName, pattern: str, replacement: str) -> Column:
    """``str_replace``: only the first regex match replaced.

    Anchors a lazy prefix so ``regexp_replace`` (which replaces all matches) can fire at most once.
    """
    anchored = f"^(?<ecopre>(?s:.*?))(?:{pattern})"
    return F.regexp_replace(_c(c), anchored, "${ecopre}" + _java_literal_replacement(replacement))


def remove_first(c: ColumnOrName, pattern: str) -> Column:
    """``str_remove``: first regex match deleted."""
    return replace_first(c, pattern, "")


def extract_first(c: ColumnOrName, pattern: str) -> Column:
    """``str_extract``: first regex match, NULL when there is none."""
    return F.regexp_substr(_c(c), F.lit(pattern))


def nth_piece(c: ColumnOrName, sep_regex: str, n: int) -> Column:
    """``str_split(x, sep)[[1]][n]``: n-th piece (1-based), NULL when absent or when x is NULL."""
    return F.try_element_at(F.split(_c(c), sep_regex), F.lit(n))


def rtrim_unicode(c: ColumnOrName) -> Column:
    """``str_trim(x, "right")``: strips trailing Unicode white space incl. NBSP."""
    return F.regexp_replace(_c(c), r"\p{IsWhite_Space}+$", "")


def detect(c: ColumnOrName, pattern: str) -> Column:
    """``str_detect``: unanchored, case-sensitive regex test; NULL in -> NULL out."""
    return _c(c).rlike(pattern)


def _java_literal_replacement(s: str) -> str:
    # '$' and '\' are special in Java replacement strings
    return s.replace("\\", "\\\\").replace("$", "\\$")
