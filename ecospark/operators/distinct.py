"""Exact distinct counts of several columns in one pass.

``count(DISTINCT a), count(DISTINCT b)`` makes Spark copy each input row once per column (Expand) before anything is combined.
Here a task combines its rows first, by group and *word* of each column: 64 neighbouring whole numbers share a word and
are bits of one long, combined by ``bit_or``; other values are words of their own.  Only the combined rows, one per word
and not per value, are then dealt out once per column.  All of it is hash aggregation of plain columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE = {"tinyint", "smallint", "int", "bigint"}


def _word(c: str, whole: bool) -> Column:
    return F.shiftright(F.col(f"`{c}`").cast("long"), 6) if whole else F.col(f"`{c}`")


def _bit(c: str, whole: bool) -> Column:
    if not whole:
        return F.lit(1).cast("long")
    place = F.col(f"`{c}`").cast("long").bitwiseAND(F.lit(63)).cast("int")
    return F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), place), F.lit(0).cast("long"))


def distinct_counts(df: DataFrame, group_by: Sequence[str], counts: dict[str, str], sums: dict[str, str] | None = None) -> DataFrame:
    """One row per group (a missing key is a group) with the number of distinct values, missing counted as one, of each
    column of ``counts`` ({new name: column}) and the sums of ``sums`` ({new name: column}).

    An empty input gives no rows.  Repeated rows count once in ``counts`` and each time in ``sums``.  A hot group is
    combined in every task before its words are dealt out by value, so no task holds a group's rows.
    """
    sums = sums or {}
    types = dict(df.dtypes)
    keys = [f"__g{i}" for i in range(len(group_by))]
    whole = [types[c] in _WHOLE for c in counts.values()]
    words, bits, adds = ([f"__{k}{i}" for i in range(n)] for k, n in (("w", len(counts)), ("b", len(counts)), ("s", len(sums))))
    rows = df.select(*[F.col(f"`{g}`").alias(k) for g, k in zip(group_by, keys)],
                     *[_word(c, w).alias(n) for c, w, n in zip(counts.values(), whole, words)],
                     *[_bit(c, w).alias(n) for c, w, n in zip(counts.values(), whole, bits)],
                     *[F.col(f"`{c}`").alias(n) for c, n in zip(sums.values(), adds)])
    out = rows.groupBy(*keys, *words).agg(*[F.bit_or(b).alias(b) for b in bits], *[F.sum(s).alias(s) for s in adds])
    which = F.lit(0)
    if len(counts) > 1:  # a combined row once per column, with that column's word and, the first time, the sums
        wordtypes = dict(out.dtypes)
        copies = [F.struct(F.lit(i).alias("__i"),
                           *[(F.col(w) if i == k else F.lit(None).cast(wordtypes[w])).alias(w) for k, w in enumerate(words)],
                           F.col(bits[i]).alias("__bits"),
                           *[(F.col(s) if i == 0 else F.lit(None).cast(wordtypes[s])).alias(s) for s in adds])
                  for i in range(len(counts))]
        out = out.select(*keys, F.explode(F.array(*copies)).alias("__c")).select(*keys, "__c.*")
        out = out.groupBy(*keys, "__i", *words).agg(F.bit_or("__bits").alias("__bits"), *[F.sum(s).alias(s) for s in adds])
        bits, which = ["__bits"] * len(counts), F.col("__i")
    size = [F.when(F.col(w).isNull(), 1).otherwise(F.bit_count(b) if full else 1) for w, b, full in zip(words, bits, whole)]
    found = out.groupBy(*keys).agg(
        *[F.sum(F.when(which == i, n).otherwise(0)).cast("long").alias(name) for i, (name, n) in enumerate(zip(counts, size))],
        *[F.sum(s).alias(name) for name, s in zip(sums, adds)])
    return found.select(*[F.col(k).alias(g) for k, g in zip(keys, group_by)], *counts, *sums)
