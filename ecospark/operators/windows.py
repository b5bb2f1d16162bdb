"""Order-dependent operators (W1-W3, A6) that never gather a whole group into one task.

Spark rows have no order, so every operator takes an explicit ``order_by``.

* ``fill`` (tidyr ``fill``) is a distributed scan: rows are cut into chunks contiguous in (group, order)
  (``operators.chunks``), so a large group is spread over many chunks; each chunk is filled locally, and the
  value that must cross a chunk boundary comes from a small per-(group, chunk) summary.  A plain
  ``Window.partitionBy(group)`` would put a group holding a third of the data into a single task.
* ``first_per_group`` (``slice(1)``) is an aggregation (``min`` of a struct led by the order key), combined
  map-side, not a ``row_number`` window.
* ``with_group_extremes`` (grouped ``mutate(min(x))``) aggregates per group and joins the result back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ecospark.operators.chunks import sort_key_columns, with_chunks
from ecospark.operators.joins import left_join

_DIRECTIONS = ("down", "up", "downup", "updown")


def _directions(cols: Sequence[str], direction: str | dict[str, str]) -> dict[str, str]:
    dirs = dict(direction) if isinstance(direction, dict) else {c: direction for c in cols}
    for c in cols:
        if dirs.get(c) not in _DIRECTIONS:
            raise ValueError(f"direction for {c!r} must be one of {_DIRECTIONS}")
    return dirs


def fill(df: DataFrame, cols: Sequence[str], group_by: Sequence[str], order_by: Sequence[str],
         direction: str | dict[str, str] = "down", chunks: int | None = None,
         strategy: str = "chunked") -> DataFrame:
    """Fill missing cells of ``cols`` from their neighbours within each group, in ``order_by`` order.

    ``direction`` may also map each column to its own direction (several ``fill`` calls over the same
    grouping and order done in one scan).  ``order_by`` should be unique within a group (ties are filled in an
    arbitrary order, as any sort would).  Non-NULL cells are never changed.  ``strategy="window"`` uses one
    window per group instead of the chunked scan; only for inputs whose groups have a proven size bound.

    The rows are written once, range-partitioned, to the shared folder (``operators.chunks``); both the rows and the
    summaries are read from there.  Nothing is collected.
    """
    dirs = _directions(cols, direction)
    if strategy == "window":
        return fill_window(df, cols, group_by, order_by, dirs)
    spark = df.sparkSession
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = list(group_by)
    # one sortable key, NULLs last in every order column (R row order after a full join: x rows, then y-only)
    ranged = with_chunks(df, sort_key_columns(g, order_by), n, "__chunk")
    ranged = ranged.withColumn("__okey", order_key(order_by))
    o = ["__okey"]

    keys = g + ["__chunk"]
    w = Window.partitionBy(*keys).orderBy(*o)
    down_w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up_w = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    order_struct = F.struct(*o)

    local = ranged
    for c in cols:
        local = (local.withColumn(f"__d_{c}", F.last(c, ignorenulls=True).over(down_w))
                 .withColumn(f"__u_{c}", F.first(c, ignorenulls=True).over(up_w)))

    # per (group, chunk): last / first non-NULL value, then carried across chunks of the same group
    summary = ranged.groupBy(*keys).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_struct)).alias(f"__last_{c}") for c in cols],
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order_struct)).alias(f"__first_{c}") for c in cols],
    )
    cw = Window.partitionBy(*g).orderBy("__chunk")
    before = cw.rowsBetween(Window.unboundedPreceding, -1)
    after = cw.rowsBetween(1, Window.unboundedFollowing)
    carry = summary.select(
        *keys,
        *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__cd_{c}") for c in cols],
        *[F.first(f"__first_{c}", ignorenulls=True).over(after).alias(f"__cu_{c}") for c in cols],
    )
    joined = left_join(local, carry, keys)

    out = []
    for c in df.columns:
        if c not in cols:
            out.append(F.col(c))
            continue
        down = F.coalesce(F.col(f"__d_{c}"), F.col(f"__cd_{c}"))
        up = F.coalesce(F.col(f"__u_{c}"), F.col(f"__cu_{c}"))
        expr = {"down": down, "up": up, "downup": F.coalesce(down, up), "updown": F.coalesce(up, down)}[dirs[c]]
        out.append(F.coalesce(F.col(c), expr).cast(dict(df.dtypes)[c]).alias(c))
    return joined.select(*out)


def order_key(order_by: Sequence[str]):
    """Struct that sorts like ``ORDER BY c1 ASC NULLS LAST, c2 ASC NULLS LAST, ...``."""
    parts = []
    for i, c in enumerate(order_by):
        parts += [F.col(c).isNull().alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*parts)


def fill_window(df: DataFrame, cols: Sequence[str], group_by: Sequence[str], order_by: Sequence[str],
                direction: str | dict[str, str] = "down") -> DataFrame:
    """Single-window ``fill`` for inputs whose groups are known to be small (one Exchange + Sort)."""
    dirs = _directions(cols, direction)
    w = Window.partitionBy(*group_by).orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    down_w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up_w = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = df
    for c in cols:
        down = F.last(c, ignorenulls=True).over(down_w)
        up = F.first(c, ignorenulls=True).over(up_w)
        expr = {"down": down, "up": up, "downup": F.coalesce(down, up), "updown": F.coalesce(up, down)}[dirs[c]]
        out = out.withColumn(c, F.coalesce(F.col(c), expr))
    return out


def first_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each group: the one with the smallest ``order_by`` per group.

    Ties on ``order_by`` are broken by the remaining columns, so the result is deterministic.  Spark limits a group
    before the shuffle: a task sends one row of each of its groups on, however hot a group is.
    """
    rest = [c for c in df.columns if c not in [*keys, *order_by]]
    order = [F.col(f"`{c}`").asc_nulls_last() for c in order_by] + [F.col(f"`{c}`").asc_nulls_first() for c in rest]
    nth = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order))
    return df.withColumn("__nth", nth).where(F.col("__nth") == 1).drop("__nth").select(*keys, *[c for c in df.columns if c not in keys])


def with_group_extremes(df: DataFrame, keys: Sequence[str], mins: Sequence[str] = (),
                        maxs: Sequence[str] = ()) -> DataFrame:
    """Each row with the extremes of its group, missing values left out.

    An all-NULL group yields NULL (R gives -Inf/Inf; downstream tests of ``is.infinite`` become ``IS NULL``).
    """
    keys = list(keys)
    agg = df.groupBy(*keys).agg(*[F.min(c).alias(f"__min_{c}") for c in mins],
                                *[F.max(c).alias(f"__max_{c}") for c in maxs])
    joined = left_join(df, agg, keys)
    repl = {c: f"__min_{c}" for c in mins} | {c: f"__max_{c}" for c in maxs}
    return joined.select(*[F.col(repl[c]).alias(c) if c in repl else F.col(c) for c in df.columns])
