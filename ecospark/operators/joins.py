"""Null-safe joins with dplyr semantics.

dplyr joins match NA keys to NA keys.  Every join here therefore compares keys with ``<=>`` (``eqNullSafe``);
Catalyst turns that into an ordinary hash / sort-merge key on ``(coalesce(k, default), isnull(k))``.

Scale notes
-----------
* A FULL OUTER join is executed as ``left LEFT JOIN right`` plus ``right LEFT ANTI distinct(left keys)``.
  Both pieces are join types for which AQE can split a skewed partition (a hot family, or the single NULL-key
  group, which hashes to one partition), whereas Spark cannot split skew inside a FULL OUTER sort-merge join.
  The anti side only needs the *distinct* left keys, which collapse map-side before any shuffle.
* No ``broadcast()`` hint is ever placed on data that grows with the input: Spark broadcasts a side only when
  its estimated (or, under AQE, measured) size is below ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ecospark.session import materialize

log = logging.getLogger(__name__)

KeySpec = Sequence[str | tuple[str, str]]


def _pairs(on: KeySpec | str) -> list[tuple[str, str]]:
    if isinstance(on, str):
        on = [on]
    return [(k, k) if isinstance(k, str) else (k[0], k[1]) for k in on]


def _cond(lcols: Sequence[Column], rcols: Sequence[Column], null_safe: bool) -> Column:
    parts = [(l.eqNullSafe(r) if null_safe else (l == r)) for l, r in zip(lcols, rcols)]
    return reduce(and_, parts)


def join(left: DataFrame, right: DataFrame, on: KeySpec | str, how: str = "inner", null_safe: bool = True,
         suffixes: tuple[str, str] = ("_x", "_y"), strategy: str = "split") -> DataFrame:
    """dplyr-style join: keys kept once (under the left name), NA keys match, clashing non-key columns suffixed.

    how: inner | left | right | full | semi | anti.
    strategy (full joins only): ``split`` = LEFT JOIN + LEFT ANTI (skew-splittable, for inputs that grow with
    the data); ``native`` = one FULL OUTER join (one shuffle per side, for tables with a proven size bound,
    e.g. per-family reference tables, and for long chains where re-using each input twice would multiply
    the plan); ``marked`` = as ``split``, but the right side is written once with a mark whether ``left`` has its
    key, so that rows without a partner (a hot missing key, mostly) are never shuffled or sorted beside a large left.
    """
    pairs = _pairs(on)
    how = {"left_outer": "left", "outer": "full", "full_outer": "full", "right_outer": "right",
           "left_semi": "semi", "left_anti": "anti"}.get(how, how)
    if how == "right":
        swapped = [(r, l) for l, r in pairs]
        out = join(right, left, swapped, "left", null_safe, (suffixes[1], suffixes[0]), strategy)
        lkeys = [l for l, _ in pairs]
        rkeys = [r for _, r in pairs]
        # present keys under the left names, left columns first as dplyr does
        out = out.select(*[F.col(r).alias(l) for l, r in zip(lkeys, rkeys)],
                         *[c for c in out.columns if c not in rkeys])
        return out

    lkeys = [l for l, _ in pairs]
    rkeys = [r for _, r in pairs]
    rtmp = [f"__rk{i}" for i in range(len(pairs))]

    if how in ("semi", "anti"):
        r = right.select(*[F.col(k).alias(t) for k, t in zip(rkeys, rtmp)])
        cond = _cond([left[k] for k in lkeys], [r[t] for t in rtmp], null_safe)
        return left.join(r, cond, "left_semi" if how == "semi" else "left_anti")

    lrest = [c for c in left.columns if c not in lkeys]
    rrest = [c for c in right.columns if c not in rkeys]
    clash = set(lrest) & set(rrest)
    lnames = {c: (c + suffixes[0] if c in clash else c) for c in lrest}
    rnames = {c: (c + suffixes[1] if c in clash else c) for c in rrest}
    if clash:
        log.info("join: suffixing clashing columns %s", sorted(clash))

    # re-project the left side only when a clashing column has to be renamed
    l = left.select(*[F.col(k) for k in lkeys], *[F.col(c).alias(lnames[c]) for c in lrest]) if clash else left
    r = right.select(*[F.col(k).alias(t) for k, t in zip(rkeys, rtmp)],
                     *[F.col(c).alias(rnames[c]) for c in rrest])
    cond = _cond([l[k] for k in lkeys], [r[t] for t in rtmp], null_safe)
    out_cols = lkeys + [lnames[c] for c in lrest] + [rnames[c] for c in rrest]

    if how in ("inner", "left"):
        return l.join(r, cond, how).select(*out_cols)
    # (full joins below also rely on l's column names: keys, then renamed rest)

    if how != "full":
        raise ValueError(f"unsupported join type {how!r}")

    if strategy == "native":
        j = l.join(r, cond, "full")
        return j.select(*[F.coalesce(F.col(k), F.col(t)).alias(k) for k, t in zip(lkeys, rtmp)],
                        *out_cols[len(lkeys):])
    if strategy == "marked":
        marked = materialize(mark_join(r, l, list(zip(rtmp, lkeys)), "__partner", null_safe), "marked")
        partners = materialize(marked.where("__partner").drop("__partner"), "partners")
        matched_or_left = l.join(partners, _cond([l[k] for k in lkeys], [partners[t] for t in rtmp], null_safe), "left").select(*out_cols)
        right_only = marked.where("NOT __partner")
        return matched_or_left.unionByName(_without_left(right_only, l, lkeys, rtmp, [lnames[c] for c in lrest], [rnames[c] for c in rrest]))
    if strategy != "split":
        raise ValueError(f"unknown strategy {strategy!r}")

    # FULL OUTER = (l LEFT JOIN r)  UNION ALL  (r rows whose key has no partner in l)
    matched_or_left = l.join(r, cond, "left").select(*out_cols)
    ltmp = [f"__lk{i}" for i in range(len(pairs))]
    lk = l.select(*[F.col(k).alias(t) for k, t in zip(lkeys, ltmp)]).distinct()
    cond2 = _cond([r[t] for t in rtmp], [lk[t] for t in ltmp], null_safe)
    right_only = r.join(lk, cond2, "left_anti")
    return matched_or_left.unionByName(_without_left(right_only, l, lkeys, rtmp, [lnames[c] for c in lrest], [rnames[c] for c in rrest]))


def _without_left(rows: DataFrame, l: DataFrame, lkeys: Sequence[str], rtmp: Sequence[str], lrest: Sequence[str],
                  rrest: Sequence[str]) -> DataFrame:
    """Rows of the right side of a full join that have no partner: the left side's other columns are missing."""
    ltypes = dict(l.dtypes)
    return rows.select(*[F.col(t).alias(k) for k, t in zip(lkeys, rtmp)],
                       *[F.lit(None).cast(ltypes[c]).alias(c) for c in lrest], *[F.col(c) for c in rrest])


def full_join(left: DataFrame, right: DataFrame, on: KeySpec | str, null_safe: bool = True,
              suffixes: tuple[str, str] = ("_x", "_y"), strategy: str = "split") -> DataFrame:
    """``full_join(x, y, by = ...)`` incl. ``multiple = "all"``."""
    return join(left, right, on, "full", null_safe, suffixes, strategy)


def left_join(left: DataFrame, right: DataFrame, on: KeySpec | str, null_safe: bool = True,
              suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """``left_join`` (J5, J6): NA keys match NA keys; fan-out kept."""
    return join(left, right, on, "left", null_safe, suffixes)


#: Column of a stored table that holds the text of its keys.
STORED_KEY = "__stored_key"


@dataclass(frozen=True)
class Stored:
    """A table of ``sinks.handoff_bucketed``: its rows, bucketed by ``STORED_KEY``; the keys; and, for keys with more rows
    than a bucket should hold, the texts of the parts they are cut into (at most twice as many as there are buckets)."""

    table: DataFrame
    on: tuple[str, ...]
    parts: tuple[tuple[str, str], ...]


def null_safe_key(columns: Sequence[Column], types: Sequence[str]) -> Column:
    """One text, never NULL, that is equal for two rows exactly if all their keys match, a missing key matching a missing
    one.  Each value is led by its length, so that no two lists of values give the same text; ``-0.0`` is ``0.0``."""
    def part(c, dtype):
        text = (c + F.lit(0.0) if dtype in ("double", "float") else c).cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.concat(F.lit("="), *[part(c, t) for c, t in zip(columns, types)])


def join_stored(left: DataFrame, stored: Stored, how: str = "left") -> DataFrame:
    """``left`` joined (left, inner or full) by the keys of a table that was handed off in buckets: the stored side is
    read bucket by bucket and never shuffled, whatever joins follow.

    Missing keys match each other.  Keys come once, then the other columns of ``left`` and of the stored table, which
    must not share names.  Keys of ``left`` are cast to the stored types.  A row of ``left`` with a key that was cut is copied
    once for each part, and each part has rows, so no row is without a partner that has one."""
    if how not in ("left", "inner", "full"):
        raise ValueError(f"unsupported join type {how!r}")
    on, table = list(stored.on), stored.table
    types = dict(table.dtypes)
    rest_l = [c for c in left.columns if c not in on]
    rest_r = [c for c in table.columns if c not in [*on, STORED_KEY]]
    if set(rest_l) & set(rest_r):
        raise ValueError(f"columns on both sides: {sorted(set(rest_l) & set(rest_r))}")
    cast = [F.col(f"`{k}`").cast(types[k]) for k in on]
    l = left.select(*[c.alias(f"__lk{i}") for i, c in enumerate(cast)], *[F.col(f"`{c}`") for c in rest_l],
                    null_safe_key(cast, [types[k] for k in on]).alias("__left_key"))
    if stored.parts:
        parts = left.sparkSession.createDataFrame(list(stored.parts), "__of string, __part string")
        l = l.join(F.broadcast(parts), l["__left_key"] == parts["__of"], "left")
        l = l.withColumn("__left_key", F.coalesce("__part", "__left_key")).drop("__of", "__part")
    j = l.join(table, l["__left_key"] == table[STORED_KEY], how)
    return j.select(*[F.coalesce(F.col(f"__lk{i}"), F.col(f"`{k}`")).alias(k) for i, k in enumerate(on)],
                    *[F.col(f"`{c}`") for c in [*rest_l, *rest_r]])


def common_keys(left: DataFrame, right: DataFrame) -> list[str]:
    keys = [c for c in left.columns if c in set(right.columns)]
    if not keys:
        raise ValueError("natural join: no common columns")
    log.info("natural join by %s", keys)
    return keys


def natural_join(left: DataFrame, right: DataFrame, how: str = "full", null_safe: bool = True,
                 strategy: str = "split") -> DataFrame:
    """``full_join(x, y)`` without ``by``: keys are the shared column names."""
    return join(left, right, common_keys(left, right), how, null_safe, strategy=strategy)


def mark_join(df: DataFrame, members: DataFrame, on: KeySpec | str, flag: str,
              null_safe: bool = True) -> DataFrame:
    """``mutate(flag = x %in% table$col)`` (J8): flag is never NULL; NA is a member only if the set holds NA.

    The member side is reduced to distinct keys first (map-side partial aggregation) so a hot key costs one row.
    """
    pairs = _pairs(on)
    mtmp = [f"__mk{i}" for i in range(len(pairs))]
    m = (members.select(*[F.col(r).alias(t) for (_, r), t in zip(pairs, mtmp)]).distinct()
         .withColumn("__member", F.lit(True)))
    cond = _cond([df[l] for l, _ in pairs], [m[t] for t in mtmp], null_safe)
    return (df.join(m, cond, "left")
            .withColumn(flag, F.coalesce(F.col("__member"), F.lit(False)))
            .drop("__member", *mtmp))


def unique_by(df: DataFrame, by: Sequence[str], message: str) -> DataFrame:
    """Pass rows through, failing the job if ``by`` is not unique.

    The check lives in a *filter*: a value column carrying ``raise_error`` would be pruned by ``count()`` or by
    a projection of the keys, letting duplicates through.  Valid input has one row per window group, so the
    window never gathers a large group.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*[F.col(k) for k in by]))
    return (df.withColumn("__dup_n", n)
            .filter(F.when(F.col("__dup_n") > 1, F.raise_error(F.lit(message)).cast("boolean"))
                    .otherwise(F.lit(True)))
            .drop("__dup_n"))


def patch(x: DataFrame, y: DataFrame, by: Sequence[str], null_safe: bool = True) -> DataFrame:
    """``rows_patch(x, y, by, unmatched = "ignore")``.

    Only NULL cells of ``x`` are filled from the matching ``y`` row; non-NULL cells never change; ``y`` rows
    without a partner are ignored; ``y`` keys must be unique (job error otherwise); ``y``'s columns must be a
    subset of ``x``'s.  Row count and order of ``x`` are preserved.
    """
    by = list(by)
    extra = [c for c in y.columns if c not in by]
    missing = [c for c in extra if c not in x.columns]
    if missing:
        raise ValueError(f"patch: columns {missing} of y are not in x")
    ytypes = dict(x.dtypes)
    ychk = unique_by(y, by, f"patch: y keys {by} are not unique")
    ktmp = [f"__pk{i}" for i in range(len(by))]
    vtmp = {c: f"__pv_{c}" for c in extra}
    yy = ychk.select(*[F.col(k).alias(t) for k, t in zip(by, ktmp)],
                     *[F.col(c).cast(ytypes[c]).alias(vtmp[c]) for c in extra])
    cond = _cond([x[k] for k in by], [yy[t] for t in ktmp], null_safe)
    joined = x.join(yy, cond, "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(vtmp[c])).alias(c) if c in vtmp else F.col(c)
                           for c in x.columns])


def patch_chain(x: DataFrame, patches: Sequence[DataFrame], by: Sequence[str], null_safe: bool = True) -> DataFrame:
    """``rows_patch`` by one table after the other (J7) with one aggregate and one join.

    The tables become one table with their rank; per key and column the first value that is present, by rank, is what
    the chain would have filled in.  The same aggregate counts the rows of each table under a key, and a key that a
    table has twice fails the job.  Columns that a table lacks are missing in it; the result equals
    ``patch(patch(x, y1, by), y2, by)`` and so on.
    """
    by, patches = list(by), list(patches)
    extra = list(dict.fromkeys(c for y in patches for c in y.columns if c not in by))
    missing = [c for c in extra if c not in x.columns]
    if missing:
        raise ValueError(f"patch: columns {missing} are not in x")
    if not patches:
        return x
    types = dict(x.dtypes)
    ktmp, vtmp = [f"__pk{i}" for i in range(len(by))], {c: f"__pv{i}" for i, c in enumerate(extra)}
    ranked = [y.select(F.lit(rank).alias("__rank"), *[F.col(k).alias(t) for k, t in zip(by, ktmp)],
                       *[(F.col(c) if c in y.columns else F.lit(None)).cast(types[c]).alias(vtmp[c]) for c in extra])
              for rank, y in enumerate(patches)]
    best = [F.min(F.when(F.col(v).isNotNull(), F.struct("__rank", v))).alias(v) for v in vtmp.values()]
    twice = reduce(lambda a, b: a | b, [F.col(f"__n{rank}") > 1 for rank in range(len(patches))])
    fill = reduce(DataFrame.unionByName, ranked).groupBy(*ktmp).agg(
        *best, *[F.count(F.when(F.col("__rank") == rank, 1)).alias(f"__n{rank}") for rank in range(len(patches))])
    # in a filter, so that no projection of other columns can leave the check out
    fill = fill.filter(F.when(twice, F.raise_error(F.lit(f"patch: y keys {by} are not unique")).cast("boolean")).otherwise(F.lit(True)))
    fill = fill.select(*ktmp, *[F.col(f"{v}.{v}").alias(v) for v in vtmp.values()])
    joined = x.join(fill, _cond([x[k] for k in by], [fill[t] for t in ktmp], null_safe), "left")
    return joined.select(*[F.coalesce(F.col(c), F.col(vtmp[c])).alias(c) if c in vtmp else F.col(c) for c in x.columns])


def null_key_report(left: DataFrame, right: DataFrame, on: KeySpec | str) -> DataFrame:
    """One-row diagnostic before a null-safe join: rows whose keys are all NULL on each side and the number of
    (left, right) pairs those rows will produce, since NA matches NA (SURVEY 4.3.3).  One aggregate over the
    two inputs' key flags; no join is run."""
    pairs = _pairs(on)

    def flags(df, keys, side):
        return df.select(F.lit(side).alias("side"),
                         reduce(and_, [F.col(k).isNull() for k in keys]).cast("long").alias("all_null"))

    u = flags(left, [l for l, _ in pairs], "left").unionByName(flags(right, [r for _, r in pairs], "right"))
    is_left, is_right = F.col("side") == "left", F.col("side") == "right"
    out = u.agg(F.count(F.when(is_left, 1)).alias("left_rows"),
                F.coalesce(F.sum(F.when(is_left, F.col("all_null"))), F.lit(0)).alias("left_null_key_rows"),
                F.count(F.when(is_right, 1)).alias("right_rows"),
                F.coalesce(F.sum(F.when(is_right, F.col("all_null"))), F.lit(0)).alias("right_null_key_rows"))
    return out.withColumn("null_key_pairs", F.col("left_null_key_rows") * F.col("right_null_key_rows"))
