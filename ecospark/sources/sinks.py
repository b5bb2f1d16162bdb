"""Sinks (K1-K3)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ecospark.operators.joins import STORED_KEY, Stored, null_safe_key
from ecospark.session import checkpoint_dir, materialize


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``write.csv``: header, missing written as ``NA`` (the R row-name column is not reproduced)."""
    df.write.mode(mode).option("header", True).option("nullValue", "NA").option("quoteAll", False).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """``saveRDS`` re-aimed as parquet (K2)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def handoff(df: DataFrame, path: str) -> DataFrame:
    """Cross-step hand-off (K3): written once as parquet, read back by the consumer."""
    write_table(df, path)
    spark: SparkSession = df.sparkSession
    return spark.read.parquet(path)


def handoff_bucketed(df: DataFrame, on: Sequence[str], buckets: int | None = None) -> Stored:
    """Hand-off of a table that is joined again and again (K3): stored in the shared folder, bucketed and sorted by the
    null-safe key of ``on``, so that ``joins.join_stored`` reads it in place.

    ``df`` is evaluated once and written; a key with more rows than an even bucket is cut into as many parts as it
    fills buckets, so a hot key does not land in one task.  Such keys are fewer than ``buckets`` (default: the session's
    shuffle partitions).  The entry is in the session's catalog; ``drop_handoff`` removes it and the files."""
    spark = df.sparkSession
    types, n = dict(df.dtypes), buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = null_safe_key([F.col(f"`{k}`") for k in on], [types[k] for k in on])
    rows = materialize(df.withColumn(STORED_KEY, key), "handoff")
    counts = rows.groupBy(STORED_KEY).count()
    even = -(-(rows.count()) // n)
    hot = {r[0]: -(-r[1] // even) for r in counts.where(F.col("count") > even).collect()} if even else {}  # fewer than n
    cut = F.lit(None)
    if hot:
        of = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
        cut = F.pmod(F.monotonically_increasing_id(), of[F.col(STORED_KEY)].cast("long"))
    # the scan of a written table gives the same numbers in every attempt of a task
    named = rows.withColumn(STORED_KEY, F.coalesce(F.concat(F.lit("~"), cut.cast("string"), F.col(STORED_KEY)), F.col(STORED_KEY)))
    name = f"handoff_{uuid.uuid4().hex}"
    (named.repartition(n, STORED_KEY).write.bucketBy(n, STORED_KEY).sortBy(STORED_KEY).format("parquet")
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    drop_files(rows)
    table = spark.table(name)
    texts = [r[0] for r in table.select(STORED_KEY).where(F.col(STORED_KEY).startswith("~")).distinct().collect()] if hot else []
    return Stored(table, tuple(on), tuple((t[t.index("="):], t) for t in texts))


def drop_files(df: DataFrame) -> None:
    """Delete the files that ``df`` is read from, if they lie in the shared folder."""
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    top = path_of(checkpoint_dir(spark)).toUri().getPath().rstrip("/") + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = path_of(folder)
        if path.toUri().getPath().startswith(top):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_handoff(stored: Stored) -> None:
    """Remove a table of ``handoff_bucketed``: its entry in the catalog and its files."""
    spark = stored.table.sparkSession
    folders = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in stored.table.inputFiles()}
    drop_files(stored.table)
    for name in folders:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _r_text(c: str, dtype: str) -> Column:
    """One value as R's ``write.csv`` prints it; NULL stays NULL (written as a bare NA)."""
    col = F.col(c)
    if dtype == "string":
        return F.concat(F.lit('"'), F.replace(col, F.lit('"'), F.lit('""')), F.lit('"'))
    if dtype == "boolean":
        return F.when(col, F.lit("TRUE")).when(~col, F.lit("FALSE"))
    if dtype in ("double", "float"):
        return r_number(col.cast("double"))
    return col.cast("string")


def r_number(x: Column) -> Column:
    """A double with at most 15 significant digits, fixed or scientific, whichever is shorter (fixed on a tie), as R
    prints it: 75, 0.3, 1e+05, 1e-04, 12345678.5.  Digits beyond the 15th are zeros.  NaN and infinite values are NULL."""
    text = F.format_string("%.14e", F.abs(x))
    digits = F.rtrim(F.replace(F.substring_index(text, "e", 1), F.lit(".")), F.lit("0"))
    power = F.substring_index(text, "e", -1).cast("int")
    size = F.length(digits)
    whole = F.greatest(power + 1, F.lit(1))
    decimals = F.greatest(size - power - 1, F.lit(0))
    fixed_width = whole + F.when(decimals > 0, decimals + 1).otherwise(0)
    short_width = size + F.when(size > 1, 1).otherwise(0) + F.when(F.abs(power) >= 100, 5).otherwise(4)
    left = F.when(power < 0, F.lit("0")).otherwise(F.rpad(F.substring(digits, F.lit(1), power + 1), power + 1, F.lit("0")))
    right = F.when(power < 0, F.concat(F.repeat(F.lit("0"), -power - 1), digits)).otherwise(F.substring(digits, power + 2, size))
    fixed = F.concat(left, F.when(decimals > 0, F.concat(F.lit("."), right)).otherwise(F.lit("")))
    rest = F.substring(digits, F.lit(2), size)
    short = F.concat(F.substring(digits, 1, 1), F.when(size > 1, F.concat(F.lit("."), rest)).otherwise(F.lit("")), F.lit("e"),
                     F.when(power < 0, F.lit("-")).otherwise(F.lit("+")), F.when(F.abs(power) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(power).cast("string"))
    body = F.when(fixed_width <= short_width, fixed).otherwise(short)
    return F.when(x == 0, F.lit("0")).when(F.abs(x) < F.lit(float("inf")),
                                           F.concat(F.when(x < 0, F.lit("-")).otherwise(F.lit("")), body))


def write_csv_r(df: DataFrame, path: str, order_by: Sequence[str | Column], mode: str = "overwrite") -> None:
    """``write.csv(df, path)`` as R writes it (K1): a leading quoted row-number column with an empty quoted
    header, quoted strings (embedded quotes doubled), unquoted numbers, ``TRUE`` / ``FALSE``, bare ``NA``.

    Row numbers are consecutive in ``order_by`` order (names, or columns such as ``F.desc("n")``), and the part files
    hold the rows in that order, each with the header line.
    """
    from ecospark.sources.delimited import with_row_number

    if not order_by:
        raise ValueError("order_by must name the order of the rows")
    numbered = with_row_number(df, "__row", order_by=list(order_by))
    cols = [F.concat(F.lit('"'), F.col("__row").cast("string"), F.lit('"')).alias('""')]
    cols += [_r_text(c, t).alias(f'"{c}"') for c, t in df.dtypes]
    out = numbered.repartitionByRange("__row").sortWithinPartitions("__row").select(*cols)
    (out.write.mode(mode).option("header", True).option("nullValue", "NA").option("quote", "")
     .option("escape", "").csv(path))
