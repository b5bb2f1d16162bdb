"""Registered queries over the actual file readers and the ordered CSV sink: the files are derived from whole
test-data tables, written to the shared scratch folder, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from ecospark import functions as ef
from ecospark.operators import aggregates, filters
from ecospark.plans import attributes
from ecospark.plans import testdata as td
from ecospark.plans import trait_rules as tr
from ecospark.plans.catalog import register
from ecospark.session import checkpoint_dir
from ecospark.sources import delimited, sinks

#: Sample columns of the wide file: every remainder of an order key, so that no row falls outside.
WIDE_SAMPLES = 1200


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _write_lines(lines, header: str, path: str) -> None:
    """One text column as lines, each file beginning with ``header``."""
    lines.toDF(header).write.option("header", True).option("sep", "\ufdd0").option("quote", "\x00") \
        .option("escapeQuotes", False).option("emptyValue", "").option("nullValue", "") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@register("wide_tsv_counts", f"""
SELECT 'c' || CAST(l_partkey AS VARCHAR) AS cluster, 'P' || CAST(l_orderkey % {WIDE_SAMPLES} AS VARCHAR) AS sample,
       CAST(sum(l_quantity) AS BIGINT) AS read_count
FROM lineitem GROUP BY ALL HAVING sum(l_quantity) > 0""")
def wide_tsv_counts(spark: SparkSession, sf_dir: str):
    """A tab-separated matrix of 1,200 sample columns over all of lineitem, read straight to long rows;
    absent cells are 0, blank or NA, counts are written as 12, 12.0 or 1.2e+01."""
    li = td.table(spark, sf_dir, "lineitem")
    cell = li.groupBy("l_partkey", F.pmod("l_orderkey", F.lit(WIDE_SAMPLES)).cast("int").alias("s")).agg(
        F.sum("l_quantity").cast("bigint").alias("n"))
    shape = F.when(F.col("n") % 3 == 0, F.concat(F.col("n").cast("string"), F.lit(".0"))) \
        .when(F.col("n") % 3 == 1, F.concat(F.col("n").cast("string"), F.lit("e+00"))).otherwise(F.col("n").cast("string"))
    # a line is made of its counts, each preceded by the blank cells since the last one
    blank = F.element_at(F.array(F.lit("0"), F.lit(""), F.lit("NA")), F.pmod("l_partkey", F.lit(3)).cast("int") + 1)
    last = F.lag("s", 1, -1).over(Window.partitionBy("l_partkey").orderBy("s"))
    cell = cell.select("l_partkey", "s", blank.alias("blank"), shape.alias("v"), last.alias("last"))
    cell = cell.withColumn("part", F.concat(F.expr("repeat(concat(blank, '\t'), s - last - 1)"), "v"))
    row = cell.groupBy("l_partkey", "blank").agg(F.array_sort(F.collect_list(F.struct("s", "part"))).alias("parts"), F.max("s").alias("end"))
    path = _scratch(spark, "wide")
    line = F.concat(F.lit("c"), F.col("l_partkey").cast("string"), F.lit("\t"), F.array_join(F.col("parts.part"), "\t"),
                    F.expr(f"repeat(concat('\t', blank), {WIDE_SAMPLES - 1} - end)"))
    _write_lines(row.select(line.alias("value")), "\t".join(["cluster", *[f"P{i}" for i in range(WIDE_SAMPLES)]]), path)
    return delimited.read_wide_counts(spark, path, "cluster")


@register("european_file", """
SELECT c_custkey AS cust_key, CASE WHEN c_custkey % 9 <> 0 THEN replace(c_name, 'r', ';') END AS cust_name,
       CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS acct_bal FROM customer""")
def european_file(spark: SparkSession, sf_dir: str):
    """A ';' separated file with decimal commas, grouping dots, quoted separators, NA and blank cells."""
    c = td.table(spark, sf_dir, "customer")
    amount = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    path = _scratch(spark, "csv2")
    c.select(F.col("c_custkey").alias("Cust Key"), F.when(F.col("c_custkey") % 9 != 0, F.translate("c_name", "r", ";")).alias("Cust-Name"),
             F.when(F.col("c_custkey") % 6 != 0, amount).alias("acctBal")) \
        .write.option("sep", ";").option("header", True).option("nullValue", "NA").csv(path)
    return delimited.read_csv2(spark, path, numeric=["acct_bal"]).withColumn("cust_key", F.col("cust_key").cast("bigint"))


@register("fread_file", """
SELECT CASE WHEN n_nationkey % 4 = 1 THEN NULL WHEN n_nationkey % 4 = 2 THEN '' ELSE n_name END AS nation,
       CASE WHEN n_nationkey % 5 = 0 THEN 'note "' || n_name || '"' ELSE 'plain' END AS note, CAST(c_custkey AS VARCHAR) AS key,
       NULL::BIGINT AS rank
FROM customer JOIN nation ON n_nationkey = c_nationkey
UNION ALL SELECT 'Nation', 'note', 'key', NULL FROM region
UNION ALL SELECT '', '', '', NULL FROM region
UNION ALL SELECT chr(1) || ' ' || s_name, NULL, CAST(s_suppkey AS VARCHAR), s_suppkey % 7 FROM supplier""")
def fread_file(spark: SparkSession, sf_dir: str):
    """Tab-separated lines where only NA is missing, blanks stay, quotes are undone, rows that repeat the
    header's text and rows of blank cells are data, control characters are text, and files with other headers are read
    by name."""
    c = td.table(spark, sf_dir, "customer").join(td.table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    nation = F.when(F.col("n_nationkey") % 4 == 1, F.lit("NA")).when(F.col("n_nationkey") % 4 == 2, F.lit("")).otherwise(F.col("n_name"))
    note = F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit('"note ""'), F.col("n_name"), F.lit('"""'))).otherwise(F.lit("plain"))
    lines = c.select(F.concat_ws("\t", nation, note, F.col("c_custkey").cast("string")).alias("value"))
    r = td.table(spark, sf_dir, "region")
    lines = lines.unionByName(r.select(F.lit("Nation\tnote\tkey").alias("value"))).unionByName(r.select(F.lit("\t\t").alias("value")))
    path = _scratch(spark, "fread")
    _write_lines(lines, "Nation\tnote\tkey", f"{path}/a")
    other = td.table(spark, sf_dir, "supplier").select(F.concat_ws("\t", "s_suppkey", F.col("s_suppkey") % 7, F.concat(F.lit("\x01 "), "s_name")))
    _write_lines(other, "key\trank\tNation", f"{path}/b")
    return delimited.read_fread(spark, [f"{path}/a", f"{path}/b"])


@register("typed_file", """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice > 150000 END AS flag,
       CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
       CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM orders) THEN 'odd' ELSE CAST(o_custkey AS VARCHAR) END AS late,
       '0' || CAST(o_custkey AS VARCHAR) AS code, NULL::BOOLEAN AS nothing,
       CASE WHEN o_orderkey % 11 = 0 THEN o_orderpriority || chr(10) || 'second, line' ELSE o_orderpriority END AS note
FROM orders""")
def typed_file(spark: SparkSession, sf_dir: str):
    """Columns of a comma file get the type that all cells have - logical, integer, double, date - and stay
    text for one odd cell in the last row or for leading zeros; a quoted cell goes over two lines."""
    o = td.table(spark, sf_dir, "orders")
    last = o.agg(F.max("o_orderkey").alias("last"))
    k = F.col("o_orderkey")
    rows = o.join(last, k == F.col("last"), "left").select(
        k.alias("id"), F.when(k % 7 != 0, F.when(F.col("o_totalprice") > 150000, "TRUE").otherwise("FALSE")).alias("flag"),
        F.when(k % 5 != 0, F.col("o_totalprice")).alias("price"), F.when(k % 3 != 0, F.col("o_orderdate").cast("date").cast("string")).alias("day"),
        F.when(F.col("last").isNotNull(), "odd").otherwise(F.col("o_custkey").cast("string")).alias("late"),
        F.concat(F.lit("0"), F.col("o_custkey").cast("string")).alias("code"), F.lit(None).cast("string").alias("nothing"),
        F.when(k % 11 == 0, F.concat("o_orderpriority", F.lit("\nsecond, line"))).otherwise(F.col("o_orderpriority")).alias("note"))
    path = _scratch(spark, "typed")
    rows.write.option("header", True).option("nullValue", "NA").option("escape", '"').csv(path)
    return delimited.read_csv(spark, path)


@register("larval_sheet", f"""
WITH g AS (SELECT p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY ALL),
s AS (SELECT *, row_number() OVER (ORDER BY p_brand, p_type, p_size) AS place FROM g)
SELECT DISTINCT p_brand AS higher_taxon, p_type || chr(10) || CAST(p_size AS VARCHAR) AS family,
       {", ".join(f"CASE WHEN (p_size + n) % {k} <> 0 THEN CAST((p_size * {k} + n) % 11 AS DOUBLE) / 10 END AS score_{k}" for k in range(4, 29))}
FROM s WHERE place NOT BETWEEN {tr.LARVAL_JUNK_ROWS[0]} AND {tr.LARVAL_JUNK_ROWS[1]}""")
def larval_sheet(spark: SparkSession, sf_dir: str):
    """A landed sheet with a title line, a header row, all 25 scores, text in score cells, family names
    over two lines, and junk rows in the middle.  A sheet has a row for each brand, type and size, however many parts."""
    s = td.table(spark, sf_dir, "part").groupBy("p_brand", "p_type", "p_size").agg(F.count(F.lit(1)).alias("n"))
    s = s.withColumn("at", F.row_number().over(Window.orderBy("p_brand", "p_type", "p_size")))
    scores = [F.when((F.col("p_size") + F.col("n")) % k != 0, (F.pmod(F.col("p_size") * k + F.col("n"), F.lit(11)) / 10).cast("string"))
              .otherwise(F.lit("n/a")) for k in range(4, 29)]
    line = F.concat_ws(",", "p_brand", F.concat(F.lit('"'), "p_type", F.lit("\n"), F.col("p_size").cast("string"), F.lit(' "')), F.lit('"a, ""b"""'), *scores, F.lit("extra"))
    head = ",".join(["Higher Taxon", "Family", "Note", *[f"Score {k}" for k in range(4, 29)], "Extra"])
    top = spark.createDataFrame([(-1, "A sheet" + "," * 28), (0, head)], "at int, value string")
    path = _scratch(spark, "larval")
    top.unionByName(s.select("at", line.alias("value"))).coalesce(1).sortWithinPartitions("at").select("value").write.text(path)
    return attributes.tidy_larval_niche(attributes.land_larval_sheet(spark, path)).drop("_ord")


@register("ordered_csv", """
SELECT row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS row, c_custkey AS key,
       CASE WHEN c_custkey % 9 <> 0 THEN c_name || '"' END AS name, c_acctbal AS balance FROM customer""")
def ordered_csv(spark: SparkSession, sf_dir: str):
    """The CSV sink with row numbers in a descending order, read back."""
    c = td.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 9 != 0, F.concat("c_name", F.lit('"'))).alias("name"),
        F.col("c_acctbal").alias("balance"))
    path = _scratch(spark, "ordered")
    sinks.write_csv_r(c, path, [F.desc("balance"), F.asc("key")])
    back = delimited.read_csv(spark, path)
    back = back.toDF("row", *back.columns[1:])
    return back.select(F.col("row").cast("bigint"), F.col("key").cast("bigint"), "name", ef.lenient_double("balance").alias("balance"))


@register("missing_contract", """
WITH t AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 5 < 2 THEN NULL ELSE p_retailprice END AS x,
                  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS s FROM part)
SELECT x IS NULL AS x_missing, s IS NULL AS s_missing, count(*) AS n,
       CAST(sum((x IS NULL)::INT + (s IS NULL)::INT) AS BIGINT) AS cells,
       count(*) FILTER (x IS NOT NULL AND s IS NOT NULL) AS complete, count(*) FILTER (x IS NULL OR s IS NULL) AS incomplete
FROM t GROUP BY ALL""")
def missing_contract(spark: SparkSession, sf_dir: str):
    """NaN counts as missing everywhere, like NULL."""
    p = td.table(spark, sf_dir, "part")
    t = p.select(F.col("p_partkey").alias("k"),
                 F.when(F.col("p_partkey") % 5 == 0, F.lit(float("nan"))).when(F.col("p_partkey") % 5 > 1, F.col("p_retailprice")).alias("x"),
                 F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("s"))
    t = aggregates.with_missing_count(t, "cells", ["x", "s"])
    t = t.withColumn("x_missing", ef.is_missing("x")).withColumn("s_missing", ef.is_missing("s"))
    keys = ["x_missing", "s_missing"]
    total = t.groupBy(*keys).agg(F.sum("cells").cast("bigint").alias("cells"))
    pattern = aggregates.missing_patterns(t.select("x", "s"), ["x", "s"]).toDF(*keys, "n")
    complete = filters.drop_na(t.select(*keys, "x", "s")).groupBy(*keys).agg(F.count(F.lit(1)).alias("complete"))
    some = filters.keep_any_missing(t, ["x", "s"]).groupBy(*keys).agg(F.count(F.lit(1)).alias("incomplete"))
    return pattern.join(total, keys).join(complete, keys, "left").join(some, keys, "left").na.fill(0, ["complete", "incomplete"])
