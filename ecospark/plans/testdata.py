"""Source-shaped tables derived from the driver test data, each as a DataFrame builder and the same
definition in SQL (for the DuckDB oracle).

The raw inputs of the original project (trait spreadsheets, cluster taxonomy, count matrix, sample metadata)
are not available, so the TPC-H-like tables stand in for them.  The test data has no NULLs; missing values
are manufactured identically on both sides with ``CASE WHEN key % n = 0 THEN NULL`` (every row is kept).

| view    | stands for                         | built from |
|---------|------------------------------------|------------|
| tm      | trait table keyed (higher_taxon, family) | part |
| taxa    | cluster taxonomy (phylum .. genus)  | part |
| cl      | long read counts (cluster, sample, reads) | lineitem |
| traps   | sequencing sample -> trap          | supplier |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test-data table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond, value):
    return F.when(~cond, value)


# ---------------------------------------------------------------- tm: trait-like table
TM_SQL = """SELECT p_partkey AS ord, p_brand AS higher_taxon,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_name END AS family,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE split_part(p_name, ' ', 2) END AS sub_family,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS length_min,
  CASE WHEN p_size % 4 = 0 THEN NULL ELSE CAST(p_size + 10 AS DOUBLE) END AS length_max,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS niche,
  CAST(p_partkey % 10 AS DOUBLE) / 10 AS score_a, CAST(p_partkey % 7 AS DOUBLE) / 7 AS score_b
FROM part"""


def tm(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("ord"),
        F.col("p_brand").alias("higher_taxon"),
        _null_when(k % 17 == 0, F.col("p_name")).alias("family"),
        _null_when(k % 5 == 0, F.split_part(F.col("p_name"), F.lit(" "), F.lit(2))).alias("sub_family"),
        _null_when(F.col("p_size") % 3 == 0, F.col("p_size").cast("double")).alias("length_min"),
        _null_when(F.col("p_size") % 4 == 0, (F.col("p_size") + 10).cast("double")).alias("length_max"),
        _null_when(k % 4 == 0, F.col("p_type")).alias("niche"),
        ((k % 10).cast("double") / 10).alias("score_a"),
        ((k % 7).cast("double") / 7).alias("score_b"),
    )


# ---------------------------------------------------------------- taxa: cluster taxonomy
TAXA_SQL = """SELECT p_partkey AS cluster,
  CASE WHEN p_size <= 45 THEN 'Arthropoda' ELSE 'Chordata' END AS phylum,
  CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Arachnida' ELSE 'Insecta' END AS class,
  p_brand AS "order",
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_name END AS family,
  CASE WHEN p_size % 9 = 0 THEN NULL ELSE split_part(p_name, ' ', 2) || '_' || CAST(p_size AS VARCHAR) END AS genus
FROM part"""


def taxa(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select(
        k.alias("cluster"),
        F.when(F.col("p_size") <= 45, F.lit("Arthropoda")).otherwise(F.lit("Chordata")).alias("phylum"),
        F.when(F.col("p_type").isin("PROMO", "SMALL"), F.lit("Arachnida")).otherwise(F.lit("Insecta")).alias("class"),
        F.col("p_brand").alias("order"),
        _null_when(k % 17 == 0, F.col("p_name")).alias("family"),
        _null_when(F.col("p_size") % 9 == 0,
                   F.concat(F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)), F.lit("_"),
                            F.col("p_size").cast("string"))).alias("genus"),
    )


# ---------------------------------------------------------------- cl: long counts
CL_SQL = """SELECT CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_partkey END AS cluster,
  l_suppkey AS sample, CAST(l_quantity AS BIGINT) AS reads
FROM lineitem"""


def cl(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        _null_when(F.col("l_partkey") % 13 == 0, F.col("l_partkey")).alias("cluster"),
        F.col("l_suppkey").alias("sample"),
        F.col("l_quantity").cast("bigint").alias("reads"),
    )


# ---------------------------------------------------------------- traps: sample -> trap
TRAPS_SQL = """SELECT s_suppkey AS sample,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_nationkey AS BIGINT) END AS trap,
  CASE WHEN s_acctbal < 0 THEN 'control' ELSE 'sample' END AS lab_sample_type
FROM supplier"""


def traps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("sample"),
        _null_when(F.col("s_suppkey") % 7 == 0, F.col("s_nationkey").cast("bigint")).alias("trap"),
        F.when(F.col("s_acctbal") < 0, F.lit("control")).otherwise(F.lit("sample")).alias("lab_sample_type"),
    )


def with_views(sql_body: str, *views: str) -> str:
    """Prefix an oracle query with the named view definitions as CTEs."""
    defs = {"tm": TM_SQL, "taxa": TAXA_SQL, "cl": CL_SQL, "traps": TRAPS_SQL}
    ctes = ",\n".join(f"{v} AS (\n{defs[v]}\n)" for v in views)
    return f"WITH {ctes}\n{sql_body}" if views else sql_body
