"""Column-set operators: header cleaning, selection by regex / ordinal, reordering, typed re-casting.

All of these work on ``df.columns`` on the driver and emit one projection; they never start a job.
"""

from __future__ import annotations

import logging
import re
import unicodedata
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Symbol spellings used by janitor-style header cleaning.
_SYMBOLS = {"%": "_percent_", "#": "_number_"}


# ASCII spellings of letters that have no decomposition.
_LETTERS = str.maketrans({"ß": "ss", "Æ": "AE", "æ": "ae", "Ø": "O", "ø": "o", "Œ": "OE", "œ": "oe", "Ð": "D", "ð": "d",
                          "Đ": "D", "đ": "d", "Ł": "L", "ł": "l", "Þ": "TH", "þ": "th", "ı": "i", "ẞ": "SS"})


def clean_name(name: str) -> str:
    """snake_case a header: ASCII transliteration, camelCase split, non-alphanumerics -> '_',
    lower case, leading digit prefixed with 'x' (so a blank spreadsheet header '...6' becomes 'x6')."""
    s = unicodedata.normalize("NFKD", name.translate(_LETTERS)).encode("ascii", "ignore").decode("ascii")
    s = s.replace("'", "").replace('"', "")
    for sym, word in _SYMBOLS.items():
        s = s.replace(sym, word)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(names: Sequence[str]) -> list[str]:
    """Clean every header and make them unique (case-insensitively, as Spark resolves names) with _2, _3."""
    out: list[str] = []
    seen: dict[str, int] = {}
    for n in names:
        base = clean_name(n)
        cand, k = base, 1
        while cand.lower() in seen:
            k += 1
            cand = f"{base}_{k}"
        seen[cand.lower()] = 1
        out.append(cand)
    return out


def clean_columns(df: DataFrame) -> DataFrame:
    """``clean_names()`` on a DataFrame."""
    return df.toDF(*clean_names(df.columns))


def matching(df: DataFrame, patterns: str | Iterable[str]) -> list[str]:
    """Columns whose name matches any regex (case-insensitive, unanchored) in frame order (``matches()``)."""
    pats = [patterns] if isinstance(patterns, str) else list(patterns)
    rx = [re.compile(p, re.IGNORECASE) for p in pats]
    return [c for c in df.columns if any(r.search(c) for r in rx)]


def select_matching(df: DataFrame, patterns: str | Iterable[str], keep_first: Sequence[str] = ()) -> DataFrame:
    """``select(a, b, matches(re))``."""
    cols = list(keep_first) + [c for c in matching(df, patterns) if c not in keep_first]
    return df.select(*cols)


def drop_matching(df: DataFrame, patterns: str | Iterable[str]) -> DataFrame:
    """``select(-matches(re))`` (P5)."""
    drop = set(matching(df, patterns))
    return df.select(*[c for c in df.columns if c not in drop])


def ordinal_names(df: DataFrame, positions: Iterable[int]) -> list[str]:
    """1-based positions -> names; negative positions mean 'all but these' (``select(-29)``)."""
    pos = list(positions)
    n = len(df.columns)
    if pos and all(p < 0 for p in pos):
        dropped = {-p for p in pos}
        return [c for i, c in enumerate(df.columns, start=1) if i not in dropped]
    for p in pos:
        if not 1 <= p <= n:
            raise IndexError(f"column position {p} outside 1..{n}")
    return [df.columns[p - 1] for p in pos]


def select_ordinal(df: DataFrame, positions: Iterable[int]) -> DataFrame:
    """``select(4:28)``, ``select(-29)``."""
    return df.select(*ordinal_names(df, positions))


def reorder_first(df: DataFrame, *first: str) -> DataFrame:
    """``select(a, b, everything())``."""
    return df.select(*first, *[c for c in df.columns if c not in first])


def rename_ordinal(df: DataFrame, position: int, new: str) -> DataFrame:
    """``rename(new = 1)``."""
    return df.withColumnRenamed(df.columns[position - 1], new)


def select_renamed(df: DataFrame, spec: Sequence[str | tuple[str, str]]) -> DataFrame:
    """``select(new = old, keep, ...)`` (P1): items are names or (new, old) pairs."""
    exprs: list[Column] = []
    for item in spec:
        if isinstance(item, tuple):
            new, old = item
            exprs.append(F.col(old).alias(new))
        else:
            exprs.append(F.col(item))
    return df.select(*exprs)


def cast_by_type(df: DataFrame, fn: Callable[[Column], Column], dtype: str = "string") -> DataFrame:
    """``mutate_if(is.character, fn)`` (P10): apply ``fn`` to every column of the given simple type."""
    return df.select(*[fn(F.col(c)).alias(c) if t == dtype else F.col(c) for c, t in df.dtypes])


def cast_matching(df: DataFrame, patterns: str | Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """``mutate_at(vars(matches(re)), fn)``."""
    hit = set(matching(df, patterns))
    return df.select(*[fn(F.col(c)).alias(c) if c in hit else F.col(c) for c in df.columns])


def null_column(name: str, dtype: str = "string") -> Column:
    """``mutate(x = NA)`` with a real type (P13): a VOID column breaks unions and parquet writes."""
    return F.lit(None).cast(dtype).alias(name)
