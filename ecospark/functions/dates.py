"""Date parsing and lubridate-style week numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ecospark.functions.strings import ColumnOrName, _c

# Fixed value: the leading text that as.Date(x, "%d/%m/%Y") consumes; anything after it is ignored, as in R.
DMY_PREFIX = r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"


def parse_dmy(c: ColumnOrName) -> Column:
    """``as.Date(x, format="%d/%m/%Y")``: NULL for junk or impossible dates (31/02)."""
    return F.try_to_date(F.regexp_substr(_c(c), F.lit(DMY_PREFIX)), "d/M/yyyy")


def block_week(c: ColumnOrName) -> Column:
    """``lubridate::week``: number of complete 7-day blocks since 1 January, plus one (not ISO weeks)."""
    d = _c(c)
    return (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")
