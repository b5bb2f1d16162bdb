"""Registered queries: one per operator group of the inventory, each over whole test-data tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ecospark.plans import summaries
from ecospark.plans import testdata as td
from ecospark.plans.catalog import register

# ------------------------------------------------------------------------------------------ family_reads
FAMILY_READS_SQL = td.with_views("""
, occ AS (
  SELECT cl.cluster, cl.reads, taxa.family, traps.trap
  FROM cl LEFT JOIN traps ON cl.sample IS NOT DISTINCT FROM traps.sample
          LEFT JOIN taxa ON cl.cluster IS NOT DISTINCT FROM taxa.cluster
  WHERE cl.reads > 0)
SELECT family, count(DISTINCT {'x': cluster}) AS n_otu, count(DISTINCT {'x': trap}) AS n_obs,
       CAST(sum(reads) AS BIGINT) AS reads
FROM occ GROUP BY family ORDER BY family NULLS LAST""", "cl", "traps", "taxa")


@register("family_reads", FAMILY_READS_SQL)
def family_reads(spark: SparkSession, sf_dir: str):
    """Reads, clusters and traps per family."""
    return summaries.family_reads(td.cl(spark, sf_dir), td.taxa(spark, sf_dir), td.traps(spark, sf_dir))
