"""Registered join queries (J1-J10) over whole test-data tables.

Each per-key source is reduced to one row (or a bounded handful of rows) per key before joining, the way the
trait sources are one row per family: joins never pair up all rows of a low-cardinality key.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ecospark.operators import filters, joins
from ecospark.plans import testdata as td
from ecospark.plans.catalog import register
from ecospark.sources import sinks


def _size_source(spark, sf_dir):
    """Body-size-like source: one row per (higher_taxon, family) with measured lengths."""
    return (filters.drop_na(td.tm(spark, sf_dir), ["length_min"])
            .groupBy("higher_taxon", "family")
            .agg(F.min("length_min").alias("length_min"), F.max("length_max").alias("length_max")))


SIZE_SQL = """size_src AS (
  SELECT higher_taxon, family, min(length_min) AS length_min, max(length_max) AS length_max
  FROM tm WHERE length_min IS NOT NULL GROUP BY higher_taxon, family)"""


def _niche_source(spark, sf_dir):
    """Feeding-niche-like source: distinct (higher_taxon, family, niche); up to 6 niches per key."""
    return filters.drop_na(td.tm(spark, sf_dir).select("higher_taxon", "family", "niche"), ["niche"]).distinct()


NICHE_SQL = """niche_src AS (
  SELECT DISTINCT higher_taxon, family, niche FROM tm WHERE niche IS NOT NULL)"""


# ------------------------------------------------------------------------------------ null_safe_full_join
@register("null_safe_full_join", td.with_views(f""", {SIZE_SQL}, {NICHE_SQL}
SELECT coalesce(a.higher_taxon, b.higher_taxon) AS higher_taxon, coalesce(a.family, b.family) AS family,
       a.length_min, a.length_max, b.niche
FROM size_src a FULL OUTER JOIN niche_src b
  ON a.higher_taxon IS NOT DISTINCT FROM b.higher_taxon AND a.family IS NOT DISTINCT FROM b.family""", "tm"))
def null_safe_full_join(spark: SparkSession, sf_dir: str):
    """Full join on two keys, NA matching NA, one-to-many allowed, keys coalesced."""
    return joins.full_join(_size_source(spark, sf_dir), _niche_source(spark, sf_dir), ["higher_taxon", "family"])


# --------------------------------------------------------------------------------- value_in_key_full_join
@register("value_in_key_full_join", td.with_views(""", a AS (
  SELECT higher_taxon, family, niche, max(score_a) AS score_a FROM tm GROUP BY higher_taxon, family, niche),
b AS (
  SELECT higher_taxon, family, niche, count(*) AS n_soil FROM tm WHERE length_max IS NOT NULL
  GROUP BY higher_taxon, family, niche)
SELECT coalesce(a.higher_taxon, b.higher_taxon) AS higher_taxon, coalesce(a.family, b.family) AS family,
       coalesce(a.niche, b.niche) AS niche, a.score_a, b.n_soil
FROM a FULL OUTER JOIN b
  ON a.higher_taxon IS NOT DISTINCT FROM b.higher_taxon AND a.family IS NOT DISTINCT FROM b.family
 AND a.niche IS NOT DISTINCT FROM b.niche""", "tm"))
def value_in_key_full_join(spark: SparkSession, sf_dir: str):
    """A value column in the key: merge when the niche agrees (NA = NA), otherwise append a row."""
    t = td.tm(spark, sf_dir)
    a = t.groupBy("higher_taxon", "family", "niche").agg(F.max("score_a").alias("score_a"))
    b = (filters.drop_na(t, ["length_max"]).groupBy("higher_taxon", "family", "niche")
         .agg(F.count(F.lit(1)).alias("n_soil")))
    return joins.full_join(a, b, ["higher_taxon", "family", "niche"])


# -------------------------------------------------------------------------------------- natural_full_join
_ORD_SQL = """o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_custkey END AS custkey,
         o_totalprice FROM orders),
c AS (
  SELECT c_custkey AS custkey, c_name, c_acctbal FROM customer)"""


def _orders_customers(spark, sf_dir):
    o = td.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 19 != 0, F.col("o_custkey")).alias("custkey"),
        "o_totalprice")
    c = td.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_acctbal")
    return o, c


@register("natural_full_join", f"""WITH {_ORD_SQL}
SELECT coalesce(o.custkey, c.custkey) AS custkey, o.o_orderkey, o.o_totalprice, c.c_name, c.c_acctbal
FROM o FULL OUTER JOIN c ON o.custkey IS NOT DISTINCT FROM c.custkey""")
def natural_full_join(spark: SparkSession, sf_dir: str):
    """Full join by the shared column names (here ``custkey``); NULL-key orders kept."""
    o, c = _orders_customers(spark, sf_dir)
    return joins.natural_join(o, c, how="full")


# ---------------------------------------------------------------------------------------- stored_full_join
@register("stored_full_join", f"""WITH {_ORD_SQL}
SELECT coalesce(o.custkey, c.custkey) AS custkey, o.o_orderkey, o.o_totalprice, c.c_name, c.c_acctbal
FROM c FULL OUTER JOIN o ON o.custkey IS NOT DISTINCT FROM c.custkey""")
def stored_full_join(spark: SparkSession, sf_dir: str):
    """The orders handed off in buckets of their null-safe key, then joined without being shuffled again."""
    o, c = _orders_customers(spark, sf_dir)
    return joins.join_stored(c, sinks.handoff_bucketed(o, ["custkey"]), "full")


# -------------------------------------------------------------------------------------- left_join_null_key
_LOOKUP_SQL = """lk AS (
  SELECT family, sub_family, min(niche) AS niche FROM tm WHERE niche IS NOT NULL GROUP BY family, sub_family),
occ AS (
  SELECT cl.cluster, cl.reads, tm.family, tm.sub_family
  FROM cl LEFT JOIN tm ON cl.cluster IS NOT DISTINCT FROM tm.ord WHERE cl.reads > 0)"""


def _occ_with_tm(spark, sf_dir):
    occ = td.cl(spark, sf_dir).filter(F.col("reads") > 0)
    t = td.tm(spark, sf_dir).select(F.col("ord").alias("cluster"), "family", "sub_family")
    return joins.left_join(occ, t, ["cluster"])


@register("left_join_null_key", td.with_views(f""", {_LOOKUP_SQL}
SELECT occ.sub_family, lk.niche, count(*) AS n_rows, CAST(sum(occ.reads) AS BIGINT) AS reads
FROM occ LEFT JOIN lk ON occ.family IS NOT DISTINCT FROM lk.family
                     AND occ.sub_family IS NOT DISTINCT FROM lk.sub_family
GROUP BY occ.sub_family, lk.niche""", "tm", "cl"))
def left_join_null_key(spark: SparkSession, sf_dir: str):
    """Every count row joined to a (family, sub_family) lookup where a NA sub-family matches the NA row."""
    t = td.tm(spark, sf_dir)
    lk = (filters.drop_na(t, ["niche"]).groupBy("family", "sub_family").agg(F.min("niche").alias("niche")))
    j = joins.left_join(_occ_with_tm(spark, sf_dir), lk, ["family", "sub_family"])
    return j.groupBy("sub_family", "niche").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.sum("reads").cast("bigint").alias("reads"))


# -------------------------------------------------------------------------------------- left_join_fanout
@register("left_join_fanout", td.with_views(f""", {_LOOKUP_SQL},
fl AS (SELECT DISTINCT family, niche FROM tm WHERE family IS NOT NULL)
SELECT fl.niche, count(*) AS n_rows, CAST(sum(occ.reads) AS BIGINT) AS reads
FROM occ LEFT JOIN fl ON occ.family IS NOT DISTINCT FROM fl.family
GROUP BY fl.niche""", "tm", "cl"))
def left_join_fanout(spark: SparkSession, sf_dir: str):
    """Family-level join where a family has several niches: each count row fans out."""
    fl = filters.drop_na(td.tm(spark, sf_dir).select("family", "niche"), ["family"]).distinct()
    j = joins.left_join(_occ_with_tm(spark, sf_dir).drop("sub_family"), fl, ["family"])
    return j.groupBy("niche").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("reads").cast("bigint").alias("reads"))


# -------------------------------------------------------------------------------------------- patch_missing
@register("patch_missing", td.with_views(""", y AS (
  SELECT higher_taxon, family, max(length_min) AS length_min, min(niche) AS niche
  FROM tm GROUP BY higher_taxon, family)
SELECT tm.ord, tm.higher_taxon, tm.family, tm.sub_family,
       coalesce(tm.length_min, y.length_min) AS length_min, tm.length_max,
       coalesce(tm.niche, y.niche) AS niche, tm.score_a, tm.score_b
FROM tm LEFT JOIN y ON tm.higher_taxon IS NOT DISTINCT FROM y.higher_taxon
                   AND tm.family IS NOT DISTINCT FROM y.family""", "tm"))
def patch_missing(spark: SparkSession, sf_dir: str):
    """``rows_patch``: only NULL cells of x are filled from the (unique-key) expert table y."""
    t = td.tm(spark, sf_dir)
    y = t.groupBy("higher_taxon", "family").agg(F.max("length_min").alias("length_min"),
                                                F.min("niche").alias("niche"))
    return joins.patch(t, y, ["higher_taxon", "family"])


# ---------------------------------------------------------------------------------------------- mark_join
@register("mark_join", """WITH c AS (
  SELECT CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey END AS custkey, c_name FROM customer),
o AS (
  SELECT CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_custkey END AS custkey FROM orders)
SELECT c.custkey, c.c_name,
       EXISTS (SELECT 1 FROM o WHERE o.custkey IS NOT DISTINCT FROM c.custkey) AS has_orders
FROM c""")
def mark_join(spark: SparkSession, sf_dir: str):
    """``in_set = key %in% other$key``: never NULL; NA key is a member because the set holds NA."""
    c = td.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 23 != 0, F.col("c_custkey")).alias("custkey"), "c_name")
    o = td.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 19 != 0, F.col("o_custkey")).alias("custkey"))
    return joins.mark_join(c, o, ["custkey"], "has_orders")
