"""Delimited-file readers with the missing-value conventions of the original tools.

Every reader scans strings and then gives a column the type that all of its cells have (``types.typed``: one aggregate
over the whole file); with ``typed=False`` columns stay text.

* readr (``read_tsv`` / ``read_csv`` / ``read_csv2``): ``NA`` and empty cells are missing.  A quoted cell may hold line
  breaks, so a file is one task; files above ``ONE_TASK`` bytes are an error unless the caller says that their records
  are lines (``multi_line=False``), which lets Spark split them.
* data.table ``fread``: only ``NA`` is missing; a blank cell of a text column stays ''.  Lines are records.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ecospark.functions.numeric import count_cell, european_double
from ecospark.operators.columns import clean_names
from ecospark.operators.reshape import explode_cells
from ecospark.session import materialize
from ecospark.sources import types

ORD = "_ord"
#: Bytes of a file that one task may read, where records can go over several lines.
ONE_TASK = 512 << 20
#: Different headers of the files of one read.
MOST_HEADERS = 200


def _records_over_lines(spark: SparkSession, path, multi_line: bool | None) -> bool:
    if multi_line is None:
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0  # sizes only
        if largest > ONE_TASK:
            raise ValueError(f"{path}: a file of {largest} bytes; say multi_line=False if its records are lines, or True to read it in one task")
        return True
    return multi_line


def _read(spark: SparkSession, path: str | Sequence[str], sep: str, header: bool, schema=None, multi_line: bool | None = None) -> DataFrame:
    reader = spark.read.option("sep", sep).option("header", header).option("nullValue", "NA") \
        .option("quote", '"').option("escape", '"').option("multiLine", _records_over_lines(spark, path, multi_line))
    if schema is not None:
        return reader.schema(schema).csv(path)
    df = reader.option("inferSchema", False).csv(path)
    return _blank_headers(df) if header else df


def _blank_headers(df: DataFrame) -> DataFrame:
    """Spark names a blank header cell ``_c<index>``; it becomes ``__<position>``, which header cleaning turns
    into ``x<position>`` as for a blank spreadsheet header.  (No dots: they would read as struct access.)"""
    names = [f"__{int(c[2:]) + 1}" if re.fullmatch(r"_c\d+", c) else c for c in df.columns]
    return df.toDF(*names) if names != df.columns else df


def _blank_to_null(df: DataFrame) -> DataFrame:
    return df.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if t == "string" else F.col(c)
                       for c, t in df.dtypes])


def _readr(df: DataFrame, clean: bool, typed: bool, grammar: types.Grammar = types.PLAIN) -> DataFrame:
    df = _blank_to_null(df)
    if typed:
        df = types.typed(df, grammar)
    return df.toDF(*clean_names(df.columns)) if clean else df


def read_tsv(spark: SparkSession, path, schema=None, clean: bool = False, typed: bool = True, multi_line: bool | None = None) -> DataFrame:
    """readr ``read_tsv``."""
    return _readr(_read(spark, path, "\t", True, schema, multi_line), clean, typed and schema is None)


def read_csv(spark: SparkSession, path, schema=None, clean: bool = False, typed: bool = True, multi_line: bool | None = None) -> DataFrame:
    """readr ``read_csv`` (S2); also the landing format for spreadsheet sheets."""
    return _readr(_read(spark, path, ",", True, schema, multi_line), clean, typed and schema is None)


def read_sheet(spark: SparkSession, path) -> DataFrame:
    """A landed spreadsheet sheet (S4) with its columns numbered ``c1``, ``c2``, ...: quoting as in ``read_csv``, cells
    over several lines included; blank cells stay as the file has them, and all columns stay text, since the first rows
    of a sheet may be titles."""
    df = _read(spark, path, ",", True)
    return df.toDF(*[f"c{i}" for i in range(1, len(df.columns) + 1)])


def read_csv2(spark: SparkSession, path, numeric: Sequence[str] = (), clean: bool = True, typed: bool = True,
              multi_line: bool | None = None) -> DataFrame:
    """readr ``read_csv2`` (S3): ';' separated, ',' decimal mark, '.' thousands mark.

    ``numeric`` names (after cleaning) are parsed as European decimals whatever their cells are, junk becoming NULL.
    """
    df = _blank_to_null(_read(spark, path, ";", True, None, multi_line))
    if clean:
        df = df.toDF(*clean_names(df.columns))
    num = set(numeric)
    df = df.select(*[european_double(c).alias(c) if c in num else F.col(f"`{c}`") for c in df.columns])
    return types.typed(df, types.EUROPEAN) if typed else df


def read_fread(spark: SparkSession, path, sep: str = "\t", clean: bool = True, typed: bool = True) -> DataFrame:
    """data.table ``fread`` (S5): only ``NA`` is missing; blank cells of text columns stay ''.

    Tab-separated files are read as text lines split on the tab (Spark's CSV reader cannot tell an unquoted
    blank from ``NA``); a field wrapped in double quotes loses the quotes and ``""`` becomes ``"``.  Every file has a
    header of its own: columns are taken by name, in the order of the first file and then of their appearance, and are
    NULL where a file has no such column.  Quoted fields holding tabs or line breaks need the CSV path (``sep`` other
    than a tab).
    """
    if sep != "\t":
        df = _read(spark, path, sep, True)
    else:
        lines, heads = _lines(spark, path)
        fields = F.split(F.col("value"), "\t", -1)
        names = list(dict.fromkeys(n for head in heads for n in head))
        df = lines.select(*[_fread_cell(F.try_element_at(fields, _by_head([h.index(n) + 1 if n in h else None for h in heads], "int"))).alias(n)
                            for n in names])
    if typed:
        df = types.typed(df, types.LEADING_ZEROS)
    return df.toDF(*clean_names(df.columns)) if clean else df


def _fread_cell(raw: Column) -> Column:
    """A cell as ``fread`` sees it: ``NA`` is missing, quotes around a field go."""
    unquoted = F.when(raw.rlike('^".*"$'), F.replace(F.regexp_extract(raw, '^"(.*)"$', 1), F.lit('""'), F.lit('"'))) \
        .otherwise(raw)
    return F.when(raw != F.lit("NA"), unquoted)


def _by_head(values: Sequence, to: str) -> Column:
    """The value of a line's header."""
    if len(set(values)) == 1:
        return F.lit(values[0]).cast(to)
    out = F.lit(None).cast(to)
    for k, v in enumerate(values):
        out = F.when(F.col("__head") == k, F.lit(v).cast(to)).otherwise(out)
    return out


def _first_lines(scan: DataFrame, first: bool) -> DataFrame:
    """The first line of every file, or all others, by place: a task has the lines of a block in order, and the block
    that starts a file starts with its header.  Batches are passed on whole, no line is looked at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            file, start = batch.column("__file").to_numpy(), batch.column("__start").to_numpy()
            new = np.ones(len(file), bool)
            new[1:] = (file[1:] != file[:-1]) | (start[1:] != start[:-1])
            new[0] = before != (file[0], start[0])
            before = file[-1], start[-1]
            yield batch.filter(pa.array((new & (start == 0)) == first))
    return scan.mapInArrow(run, scan.schema)


def _lines(spark: SparkSession, path) -> tuple[DataFrame, list[list[str]]]:
    """The text lines of tab-separated files (``value``) without the first line of each file, the number of the file's
    header (``__head``), and the names in the headers, that of the first file first.

    Headers are found and left out by their place in the file.  Empty lines are skipped; lines of blank cells are not."""
    scan = spark.read.text(path).select("value", F.xxhash64("_metadata.file_path").alias("__file"),
                                        F.col("_metadata.file_block_start").alias("__start"), F.col("_metadata.file_path").alias("__path"))
    found = _first_lines(scan, True).groupBy("value").agg(F.min("__path").alias("path"), F.collect_list("__file").alias("files"))
    heads = found.select("value", "path").orderBy("path").limit(MOST_HEADERS + 1).collect()
    if not heads:
        raise ValueError(f"{path}: empty file")
    if len(heads) > MOST_HEADERS:
        raise ValueError(f"{path}: more than {MOST_HEADERS} different headers")
    lines = _first_lines(scan.select("value", "__file", "__start"), False).where(F.col("value") != "")
    if len(heads) == 1:
        lines = lines.select("value", F.lit(0).alias("__head"))
    else:
        number = F.lit(0)
        for k, h in enumerate(heads):
            number = F.when(F.col("value") == h["value"], k).otherwise(number)
        of = found.select(number.alias("__head"), F.explode("files").alias("__file"))
        lines = lines.join(of, "__file").select("value", "__head")
    names = [[_unquote_text(n) for n in h["value"].removeprefix("\ufeff").split("\t")] for h in heads]
    return lines, [[n if n else f"__{i}" for i, n in enumerate(head, start=1)] for head in names]


def read_wide_counts(spark: SparkSession, path, id_col: str, names_to: str = "sample", values_to: str = "read_count",
                     clean: bool = False) -> DataFrame:
    """A wide tab-separated count matrix straight to long rows (S5, R3): ``id_col``, ``names_to``, ``values_to``
    (BIGINT) for every cell above zero.

    The cells that hold something are found in the bytes of the lines and kept as one array a line, so neither the plan nor
    the work for a cell grows with the number of samples.  Every file's cells are named by its own header.  Blank, ``NA`` and unreadable cells count as missing; ``12.0`` and ``1e+05`` are counts.
    """
    lines, heads = _lines(spark, path)
    if any(id_col not in head for head in heads):
        raise ValueError(f"{path}: no column {id_col!r}")
    places = [head.index(id_col) for head in heads]
    labels = [(clean_names(head) if clean else list(head)) for head in heads]
    # almost all cells are plain zeros or blanks: they are left out by their bytes, and only the rest become strings
    found = _placed_cells(lines, places, [len(head) for head in heads])
    for label, place in zip(labels, places):
        del label[place]
    long = explode_cells(found, [_fread_cell(F.col("__id")).alias(id_col)], F.col("__cells"), labels, names_to, values_to,
                         head=F.col("__head"), placed=True)
    return long.withColumn(values_to, count_cell(values_to)).filter(F.col(values_to) > 0)


#: Bytes of lines that are searched at a time.
SEARCHED = 1 << 20


def _placed_cells(lines: DataFrame, places: Sequence[int], widths: Sequence[int]) -> DataFrame:
    """``__head``, ``__id`` (the cell at the header's place, NULL in a line that ends before) and ``__cells``: the position
    and text of every other cell of a line that is not ``0``, blank or ``NA``.  Cells beyond the header are left out, and
    positions do not count the id.  Cells are found by the tabs in the bytes of many lines at once."""
    place_of, width_of = np.array(places, np.int64), np.array(widths, np.int64)

    # helpers travel with the function: workers may lack this package
    def strings(data: np.ndarray, start: np.ndarray, size: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
        """The pieces of ``data`` as strings."""
        ends = np.concatenate([[0], np.cumsum(size)])
        picked = data[np.repeat(start - ends[:-1], size) + np.arange(ends[-1])]
        valid = None if missing is None else pa.py_buffer(np.packbits(~missing, bitorder="little").tobytes())
        return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(picked), valid).cast(pa.string())

    def cells_of(data: np.ndarray, ends: np.ndarray, place: np.ndarray, width: np.ndarray) -> tuple[pa.Array, pa.Array]:
        """Ids and placed cells of lines, given as their bytes and the offsets of their ends (the first is 0)."""
        tabs = np.flatnonzero(data == 9)
        inner = np.searchsorted(tabs, ends)  # tabs before each line
        count = np.diff(inner) + 1  # cells of a line
        first = np.concatenate([[0], np.cumsum(count)])
        start, stop = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        after = np.ones(first[-1], bool)  # cells that follow a tab
        after[first[:-1]] = False
        start[first[:-1]], start[after] = ends[:-1], tabs + 1
        stop[first[1:] - 1] = ends[1:]
        before = np.ones(first[-1], bool)
        before[first[1:] - 1] = False
        stop[before] = tabs
        size = stop - start
        one, two = (data[np.minimum(start + k, len(data) - 1)] if len(data) else np.zeros(len(start), np.uint8) for k in (0, 1))
        full = np.flatnonzero((size > 0) & ~((size == 1) & (one == ord("0"))) & ~((size == 2) & (one == ord("N")) & (two == ord("A"))))
        line = np.searchsorted(first, full, "right") - 1
        at = full - first[line]
        kept = (at != place[line]) & (at < width[line])
        full, line, at = full[kept], line[kept], at[kept]
        at -= at > place[line]
        lists = np.concatenate([[0], np.cumsum(np.bincount(line, minlength=len(count)))])
        short = place >= count
        of = np.where(short, 0, first[:-1] + np.where(short, 0, place))
        ids = strings(data, start[of], np.where(short, 0, size[of]), short)
        cells = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), strings(data, start[full], size[full])], ["at", "cell"])
        return ids, pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("value").cast(pa.large_binary())
            ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
            at = 0
            while at < len(text):
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + SEARCHED, "right")) - 1)
                head = batch.column("__head").slice(at, to - at)
                yield pa.RecordBatch.from_arrays([head, *cells_of(
                    np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[at]:ends[to]], ends[at:to + 1] - ends[at],
                    place_of[head.to_numpy()], width_of[head.to_numpy()])], ["__head", "__id", "__cells"])
                at = to
    return lines.select("value", "__head").mapInArrow(run, "__head int, __id string, __cells array<struct<at: int, cell: string>>")


def _unquote_text(s: str) -> str:
    return s[1:-1].replace('""', '"') if len(s) >= 2 and s[0] == s[-1] == '"' else s


def with_row_number(df: DataFrame, name: str = "_row", order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """Consecutive 1-based row numbers, computed without a single-partition window.

    Without ``order_by`` the numbering follows scan order (apply it directly to the scan of one landed file).
    With ``order_by`` the rows are first range-partitioned and sorted on those columns, so the numbering is
    the global sort order and every partition stays bounded.
    """
    if order_by:
        return _ordered_row_number(df, name, list(order_by))
    return _numbered(df.withColumn("__mid", F.monotonically_increasing_id()), name)


def _ordered_row_number(df: DataFrame, name: str, order_by: list[str | Column]) -> DataFrame:
    """Row numbers in ``order_by`` order: the rows are range-partitioned, sorted and written once to the shared folder
    with their place, so numbering reads a fixed order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by) \
        .withColumn("__mid", F.monotonically_increasing_id())
    return _numbered(materialize(placed, "ordered"), name)


def _numbered(placed: DataFrame, name: str) -> DataFrame:
    """Consecutive numbers from ``__mid``, which keeps the partition in its upper 31 bits and the place in the lower
    33; per-partition counts (one tiny aggregate) give each partition's offset."""
    base = placed.withColumn("__pid", F.shiftright(F.col("__mid"), 33)) \
                 .withColumn("__pos", F.col("__mid").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = base.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.select("__pid", (F.sum("__n").over(
        Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1))).alias("__off"))
    out = base.join(offsets, "__pid", "left") \
        .withColumn(name, (F.coalesce(F.col("__off"), F.lit(0)) + F.col("__pos") + 1).cast("bigint"))
    return out.drop("__mid", "__pid", "__pos", "__off")


def promote_header(df: DataFrame, row: int = 1, row_col: str = "_row") -> DataFrame:
    """janitor ``row_to_names(row)`` (S7): the given data row becomes the header; it and the rows above go.

    ``df`` must carry ``row_col`` (see :func:`with_row_number`); the new names are cleaned later by the caller.
    The single header row is the only thing brought to the driver.
    """
    data_cols = [c for c in df.columns if c != row_col]
    hdr = df.filter(F.col(row_col) == row).select(*data_cols).first()
    if hdr is None:
        raise ValueError(f"row {row} not present")
    names = [("" if v is None else str(v)) for v in hdr]
    names = [n if n else f"__{i}" for i, n in enumerate(names, start=1)]
    out = df.filter(F.col(row_col) > row).withColumn(row_col, F.col(row_col) - row)
    return out.toDF(*names, row_col)


def drop_row_range(df: DataFrame, first: int, last: int, row_col: str = "_row") -> DataFrame:
    """``slice(-first:-last)`` (S8): drop rows by 1-based position."""
    return df.filter(~F.col(row_col).between(first, last))
