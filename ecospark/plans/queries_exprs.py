"""Registered queries for scalar functions (X1-X17), column-set operators (P1-P12, S9) and file round trips
(S1-S8, K1-K3)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ecospark import functions as ef
from ecospark.operators import columns
from ecospark.plans import testdata as td
from ecospark.plans import trait_rules as tr
from ecospark.plans.catalog import register
from ecospark.session import checkpoint_dir
from ecospark.sources import delimited, sinks


# ---------------------------------------------------------------------------------------- strings
@register("extract_tokens", """
WITH t AS (
  SELECT p_partkey, p_brand, replace(p_brand || ' ' || p_name, ' ', '_') AS taxon,
         CASE WHEN p_size % 2 = 0 THEN p_name || '-' || p_type ELSE p_name END AS dyntaxa
  FROM part)
SELECT p_partkey, taxon,
       NULLIF(regexp_extract(taxon, '^([^_]+)', 1), '') AS higher_taxon,
       NULLIF(regexp_extract(taxon, '_([^_]+)', 1), '') AS family,
       NULLIF(regexp_extract(p_brand, '[0-9]{2}', 0), '') AS two_digits,
       string_split(dyntaxa, '-')[2] AS sub_family,
       NULLIF(regexp_extract(dyntaxa, '[^-]+', 0), '') AS family_part
FROM t""")
def extract_tokens(spark: SparkSession, sf_dir: str):
    """Replace-all, leading token, look-behind token, no-match NULL, split piece or NULL."""
    p = td.table(spark, sf_dir, "part")
    t = p.select("p_partkey", "p_brand",
                 ef.replace_all(F.concat_ws(" ", "p_brand", "p_name"), " ", "_").alias("taxon"),
                 F.when(F.col("p_size") % 2 == 0, F.concat_ws("-", "p_name", "p_type"))
                 .otherwise(F.col("p_name")).alias("dyntaxa"))
    return t.select("p_partkey", "taxon",
                    ef.extract_first("taxon", "^([^_]+)").alias("higher_taxon"),
                    ef.extract_first("taxon", "(?<=_)[^_]+").alias("family"),
                    ef.extract_first("p_brand", "[0-9]{2}").alias("two_digits"),
                    ef.nth_piece("dyntaxa", "-", 2).alias("sub_family"),
                    ef.extract_first("dyntaxa", "([^-])+").alias("family_part"))


@register("replace_first", """
SELECT page_id, regexp_replace(url, 'p', 'P') AS url_p, regexp_replace(url, 'e', 'E') AS url_e FROM pages""")
def replace_first(spark: SparkSession, sf_dir: str):
    """First match only (restores an upper-case sample-id prefix after header lower-casing)."""
    p = td.table(spark, sf_dir, "pages")
    return p.select("page_id", ef.replace_first("url", "p", "P").alias("url_p"),
                    ef.replace_first("url", "e", "E").alias("url_e"))


@register("remove_first", """
SELECT p_partkey, regexp_replace(p_name, 'a', '') AS name_a,
       regexp_replace(p_brand || ', ' || p_type || ', ' || p_name, '.*,\\s', '') AS after_last_comma
FROM part""")
def remove_first(spark: SparkSession, sf_dir: str):
    """First match removed; a greedy ``.*,\\s`` keeps what follows the last comma."""
    p = td.table(spark, sf_dir, "part")
    return p.select("p_partkey", ef.remove_first("p_name", "a").alias("name_a"),
                    ef.remove_first(F.concat_ws(", ", "p_brand", "p_type", "p_name"), r".*,\s")
                    .alias("after_last_comma"))


@register("rtrim_unicode", """
SELECT p_partkey, rtrim(CASE WHEN p_size % 3 = 0 THEN ' ' || p_name || ' ' || chr(160)
                             WHEN p_size % 3 = 1 THEN p_name || chr(9) || '  '
                             ELSE p_name END, ' ' || chr(160) || chr(9)) AS family
FROM part""")
def rtrim_unicode(spark: SparkSession, sf_dir: str):
    """Right trim of all Unicode white space (NBSP and tab included), leading blanks kept."""
    p = td.table(spark, sf_dir, "part")
    raw = (F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), F.col("p_name"), F.lit(" \u00a0")))
           .when(F.col("p_size") % 3 == 1, F.concat(F.col("p_name"), F.lit("\t  ")))
           .otherwise(F.col("p_name")))
    return p.select("p_partkey", ef.rtrim_unicode(raw).alias("family"))


# ------------------------------------------------------------------------------------------- rules
LV_SQL = """lv AS (
  SELECT p_partkey AS ord,
         CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS niche,
         CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'Plants' END AS habitat,
         split_part(p_name, ' ', 2) AS sub_family, p_brand AS higher_taxon,
         CAST(p_partkey % 10 AS DOUBLE) / 10 AS saprophagous, CAST(p_partkey % 7 AS DOUBLE) / 7 AS zoophagous,
         CAST(p_size % 11 AS DOUBLE) / 10 AS phytophagous, CAST(p_partkey % 3 AS DOUBLE) / 2 AS larva_aquatic,
         CAST(p_size % 5 AS DOUBLE) / 4 AS mycetophagous, CAST(p_partkey % 9 AS DOUBLE) / 8 AS coprophagous,
         CAST(p_size % 6 AS DOUBLE) / 5 AS saproxylic, CAST(p_partkey % 8 AS DOUBLE) / 7 AS roots
  FROM part)"""


def _lv(spark, sf_dir):
    """Larval-score-like frame: a nullable niche / habitat and eight scores in [0, 1] per part."""
    p = td.table(spark, sf_dir, "part")
    k, s = F.col("p_partkey"), F.col("p_size")
    return p.select(
        k.alias("ord"),
        F.when(k % 4 != 0, F.col("p_type")).alias("niche"),
        F.when(k % 3 != 0, F.lit("Plants")).alias("habitat"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("sub_family"),
        F.col("p_brand").alias("higher_taxon"),
        ((k % 10).cast("double") / 10).alias("saprophagous"), ((k % 7).cast("double") / 7).alias("zoophagous"),
        ((s % 11).cast("double") / 10).alias("phytophagous"), ((k % 3).cast("double") / 2).alias("larva_aquatic"),
        ((s % 5).cast("double") / 4).alias("mycetophagous"), ((k % 9).cast("double") / 8).alias("coprophagous"),
        ((s % 6).cast("double") / 5).alias("saproxylic"), ((k % 8).cast("double") / 7).alias("roots"),
    )


@register("rules_threshold_fill", f"""WITH {LV_SQL}
SELECT ord,
  CASE WHEN niche IS NULL AND saprophagous > .5 THEN 'Saprophagous'
       WHEN niche IS NULL AND zoophagous > .5 THEN 'Predator'
       WHEN niche IS NULL AND phytophagous > .5 THEN 'Phytophagous'
       ELSE niche END AS niche,
  CASE WHEN habitat IS NULL AND larva_aquatic > .5 THEN 'Water'
       WHEN habitat IS NULL AND phytophagous > .5 THEN 'Plants'
       WHEN habitat IS NULL AND mycetophagous > .5 THEN 'Fungi'
       WHEN habitat IS NULL AND coprophagous > .5 THEN 'Temporary habitats'
       WHEN habitat IS NULL AND saproxylic > .5 AND phytophagous > .5 THEN 'Wood'
       WHEN habitat IS NULL AND roots > .5 THEN 'Soil'
       ELSE habitat END AS habitat
FROM lv""")
def rules_threshold_fill(spark: SparkSession, sf_dir: str):
    """The recipe's niche and habitat fill tables (first match wins; Wood unreachable, D5)."""
    lv = _lv(spark, sf_dir)
    return lv.select("ord", ef.threshold_fill("niche", tr.NICHE_FILL).alias("niche"),
                     ef.threshold_fill("habitat", tr.HABITAT_FILL).alias("habitat"))


# Fixed values for the test-data analogue of the sub-family override table (part names stand in for taxa).
_TD_OVERRIDES = [("sub_family", "ring", "Phytophage-parasitoid"), ("sub_family", "gear", "Predator"),
                 ("sub_family", "bolt", "Phytophate-parasitoid"), ("higher_taxon", "Brand#3", "Predators")]


@register("rules_override", f"""WITH {LV_SQL}
SELECT ord,
  CASE WHEN sub_family = 'ring' THEN 'Phytophage-parasitoid' WHEN sub_family = 'gear' THEN 'Predator'
       WHEN sub_family = 'bolt' THEN 'Phytophate-parasitoid' WHEN higher_taxon = 'Brand#3' THEN 'Predators'
       ELSE niche END AS niche
FROM lv""")
def rules_override(spark: SparkSession, sf_dir: str):
    """X11: unconditional override keyed on other columns, first match wins."""
    return _lv(spark, sf_dir).select("ord", ef.override("niche", _TD_OVERRIDES).alias("niche"))


_TD_CATEGORIES = [("ring|bolt|gear", "Saprophagous"), ("widget", "Phytophagous"), ("gizmo", "Predator")]


@register("rules_regex_category", """
SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'ring|bolt|gear') THEN 'Saprophagous'
                       WHEN regexp_matches(p_name, 'widget') THEN 'Phytophagous'
                       WHEN regexp_matches(p_name, 'gizmo') THEN 'Predator' END AS niche
FROM part""")
def rules_regex_category(spark: SparkSession, sf_dir: str):
    """Regex -> category, no default (NULL when nothing matches)."""
    p = td.table(spark, sf_dir, "part")
    return p.select("p_partkey", ef.regex_category("p_name", _TD_CATEGORIES).alias("niche"))


_TD_SYNONYMS = {"PROMO": "STANDARD", "ECONOMY": "STANDARD", "LARGE": "BIG"}


@register("recode_synonyms", td.with_views("""
SELECT ord, CASE niche WHEN 'PROMO' THEN 'STANDARD' WHEN 'ECONOMY' THEN 'STANDARD' WHEN 'LARGE' THEN 'BIG'
                       ELSE niche END AS niche
FROM tm""", "tm"))
def recode_synonyms(spark: SparkSession, sf_dir: str):
    """Dictionary recode; unlisted values and NULL unchanged."""
    return td.tm(spark, sf_dir).select("ord", ef.recode("niche", _TD_SYNONYMS).alias("niche"))


# ----------------------------------------------------------------------------------------- numbers
@register("lenient_numeric", """
SELECT p_partkey,
  CASE WHEN p_size % 5 = 0 OR p_size % 7 = 0 THEN NULL ELSE p_retailprice END AS price,
  CASE WHEN p_size % 3 = 0 THEN CAST(p_size + 1 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) END AS size_repaired
FROM part""")
def lenient_numeric(spark: SparkSession, sf_dir: str):
    """Text -> double with junk ('n/a', R-invalid '12.5d') -> NULL; missing value repaired from a
    second parsed column."""
    p = td.table(spark, sf_dir, "part")
    price_txt = (F.when(F.col("p_size") % 5 == 0, F.lit("n/a"))
                 .when(F.col("p_size") % 7 == 0, F.concat(F.col("p_retailprice").cast("string"), F.lit("d")))
                 .otherwise(F.col("p_retailprice").cast("string")))
    raw = p.select("p_partkey", price_txt.alias("price"),
                   F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("string")).alias("size_txt"),
                   F.concat(F.lit(" "), (F.col("p_size") + 1).cast("string"), F.lit(" ")).alias("size_alt"))
    typed = columns.cast_by_type(raw, ef.lenient_double, "string")
    return typed.select("p_partkey", "price",
                        F.coalesce(F.col("size_txt"), F.col("size_alt")).alias("size_repaired"))


@register("european_decimal", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN NULL ELSE round(p_retailprice * 10, 2) END AS price
FROM part""")
def european_decimal(spark: SparkSession, sf_dir: str):
    """S3: '1.234,56' text ('.' thousands, ',' decimal) parsed to 1234.56; junk -> NULL."""
    p = td.table(spark, sf_dir, "part")
    us = F.format_number(F.col("p_retailprice") * 10, 2)        # '12,345.60'
    eu = F.translate(us, ",.", ".,")                              # '12.345,60'
    txt = F.when(F.col("p_size") % 5 == 0, F.lit("n/a")).otherwise(eu)
    return p.select("p_partkey", F.round(ef.european_double(txt), 2).alias("price"))


# ------------------------------------------------------------------------------------------- dates
@register("parse_date_block_week", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS collecting_date,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST((dayofyear(o_orderdate) - 1) // 7 + 1 AS INTEGER) END
    AS week_year
FROM orders""")
def parse_date_block_week(spark: SparkSession, sf_dir: str):
    """dd/mm/yyyy text (junk, trailing text) -> DATE -> lubridate-style week."""
    o = td.table(spark, sf_dir, "orders")
    txt = (F.when(F.col("o_orderkey") % 50 == 0, F.lit("bad"))
           .when(F.col("o_orderkey") % 7 == 0, F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" 12:00")))
           .otherwise(F.date_format("o_orderdate", "d/M/yyyy")))
    d = ef.parse_dmy(txt)
    return o.select("o_orderkey", d.alias("collecting_date"), ef.block_week(d).alias("week_year"))


# ----------------------------------------------------------------------------------------- factors
_PRIORITY_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@register("levels_factor", """
WITH g AS (SELECT o_orderpriority AS p, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
SELECT CASE WHEN p IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN p END AS o_orderpriority, o_orderstatus,
       CASE p WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 END AS level, n
FROM g WHERE NOT regexp_matches(p, 'LOW')""")
def levels_factor(spark: SparkSession, sf_dir: str):
    """Counts per group, regex exclusion, then a fixed level set: non-levels become NULL, rows kept."""
    o = td.table(spark, sf_dir, "orders")
    g = o.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    g = g.filter(~F.col("o_orderpriority").rlike("LOW"))
    return (g.select(ef.as_level("o_orderpriority", _PRIORITY_LEVELS).alias("o_orderpriority"), "o_orderstatus",
                     ef.level_index("o_orderpriority", _PRIORITY_LEVELS).alias("level"), "n")
            .orderBy(F.asc_nulls_last("level"), "o_orderstatus"))


# ------------------------------------------------------------------------------------- column sets
_MESSY = ["Order Key", "Cust-Key", "orderStatus", "Total Price (%)", "Order#Date", "o  priority"]


@register("clean_names", """
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status,
       o_totalprice AS total_price_percent, o_orderdate AS order_number_date, o_orderpriority AS o_priority
FROM orders""")
def clean_names(spark: SparkSession, sf_dir: str):
    """Janitor-style header cleaning (snake case, symbols spelled out, unique)."""
    o = td.table(spark, sf_dir, "orders").toDF(*_MESSY)
    return columns.clean_columns(o)


@register("select_regex_ordinal_reorder", """
SELECT o_totalprice AS total_price_percent, o_orderkey AS okey, o_custkey AS cust_key,
       o_orderstatus AS status
FROM orders""")
def select_regex_ordinal_reorder(spark: SparkSession, sf_dir: str):
    """Drop by ordinal, keep by regex, reorder, rename by ordinal and by name."""
    o = columns.clean_columns(td.table(spark, sf_dir, "orders").toDF(*_MESSY))
    o = columns.select_ordinal(o, [-6])                                # select(-6)
    o = columns.select_matching(o, ["key", "price", "status"])          # select(matches(...))
    o = columns.reorder_first(o, "total_price_percent")                 # select(x, everything())
    o = columns.rename_ordinal(o, 2, "okey")                            # rename(okey = 2)
    o = columns.select_renamed(o, ["total_price_percent", "okey", "cust_key", ("status", "order_status")])
    return o


# -------------------------------------------------------------------------------------- round trips
def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_CUST_NULLS_SQL = """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS c_name,
       c_nationkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       c_mktsegment FROM customer"""


def _customer_with_nulls(spark, sf_dir):
    c = td.table(spark, sf_dir, "customer")
    return c.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_name")).alias("c_name"),
                    "c_nationkey", F.when(F.col("c_custkey") % 6 != 0, F.col("c_acctbal")).alias("c_acctbal"),
                    "c_mktsegment")


@register("csv_roundtrip", _CUST_NULLS_SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str):
    """Write CSV / TSV with NA, read back with lenient typing; parquet hand-off."""
    c = _customer_with_nulls(spark, sf_dir)
    csv_path, tsv_path, pq_path = (_scratch(spark, n) for n in ("csv", "tsv", "parquet"))
    sinks.write_csv(c, csv_path)
    back = delimited.read_csv(spark, csv_path)
    c.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "NA").csv(tsv_path)
    tsv = delimited.read_tsv(spark, tsv_path).select("c_custkey", "c_mktsegment")
    typed = back.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("int"),
                        ef.lenient_double("c_acctbal").alias("c_acctbal"))
    typed = typed.join(tsv.select(F.col("c_custkey").cast("bigint"), "c_mktsegment"), "c_custkey")
    return sinks.handoff(typed, pq_path)


@register("header_promotion", """
SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS acct_balance FROM customer
WHERE c_custkey NOT BETWEEN 586 AND 601""")
def header_promotion(spark: SparkSession, sf_dir: str):
    """A sheet whose first data row holds the header; junk rows 587-602 removed by position."""
    c = td.table(spark, sf_dir, "customer")
    header = spark.createDataFrame([(0, "Customer Key", "Customer Name", "Acct Balance", "")],
                                   "_src long, a string, b string, c string, d string")
    body = c.select((F.col("c_custkey") + 1).alias("_src"), F.col("c_custkey").cast("string").alias("a"),
                    F.col("c_name").alias("b"), F.col("c_acctbal").cast("string").alias("c"), F.lit("x").alias("d"))
    path = _scratch(spark, "sheet")
    header.unionByName(body).write.mode("overwrite").option("header", False).csv(path)
    raw = spark.read.schema("_src long, a string, b string, c string, d string").csv(path)
    numbered = delimited.with_row_number(raw, "_row", order_by=["_src"]).drop("_src")
    sheet = delimited.promote_header(numbered, 1)                     # row_to_names(1)
    sheet = columns.select_ordinal(sheet, [-4])                        # select(-4): the unnamed column
    sheet = delimited.drop_row_range(sheet, *tr.LARVAL_JUNK_ROWS)      # slice(-587:-602)
    sheet = columns.clean_columns(sheet.drop("_row"))
    return sheet.select(F.col("customer_key").cast("bigint"), "customer_name",
                        ef.lenient_double("acct_balance").alias("acct_balance"))

