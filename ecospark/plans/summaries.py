"""Summary recipes (C20-C23): reads and samples per family, missing-trait reports, family checklist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark.operators.aggregates import frequency_table, missing_by_group, with_missing_count
from ecospark.operators.columns import matching
from ecospark.operators.distinct import distinct_counts
from ecospark.operators.filters import keep_any_missing
from ecospark.operators.joins import left_join, natural_join


def family_reads(counts: DataFrame, taxonomy: DataFrame, sample_traps: DataFrame, *, cluster: str = "cluster",
                 sample: str = "sample", reads: str = "reads", family: str = "family",
                 trap: str = "trap", sort: bool = True) -> DataFrame:
    """C20: per family, clusters with reads (``n_otu``), distinct traps (``n_obs``), total reads.

    Both distinct counts count NA as a value, as ``length(unique(x))`` does.

    The reference builds ``full_join(taxonomy, counts) -> pivot_longer -> full_join(meta) -> filter(reads > 0)``.
    The filter removes every row that exists only on the taxonomy or metadata side, so the plan is
    ``counts LEFT JOIN traps LEFT JOIN taxonomy`` with the count filter pushed into the scan.  The per-sample
    and per-cluster tables are broadcast when their size allows (checked by the planner), so the count table
    is shuffled once, combined in its tasks to bit words per family (``distinct_counts``).  (An explicit
    (cluster, sample) pre-aggregation would add a full shuffle and combine nothing: a count matrix has one
    cell per pair.)
    """
    occ = counts.filter(F.col(reads) > 0).select(cluster, sample, reads)
    occ = left_join(occ, sample_traps.select(sample, trap), [sample])
    occ = left_join(occ, taxonomy.select(cluster, family), [cluster])
    out = distinct_counts(occ, [family], {"n_otu": cluster, "n_obs": trap}, {"reads": reads})
    out = out.withColumn("reads", F.col("reads").cast("bigint"))
    return out.orderBy(F.asc_nulls_last(family)) if sort else out


TRAIT_REPORT_COLS = ("length_min", "length_max", "main_feeding_niche", "main_feeding_habitat")


def missing_attributes(all_attributes: DataFrame, trait_cols: Sequence[str] = TRAIT_REPORT_COLS,
                   key_cols: Sequence[str] = ("higher_taxon", "family"), flag: str = "in_checklist") -> DataFrame:
    """C21 first half: families with at least one missing trait among the ``main|length`` columns."""
    sel = all_attributes.select(*key_cols, *trait_cols, flag)
    return keep_any_missing(sel, matching(sel, ["main", "length"]))


def missing_attributes_seq(missing: DataFrame, reads: DataFrame, flag: str = "in_checklist") -> DataFrame:
    """Missing-trait families joined to their read totals, kept only when the flag is TRUE.

    Rows that only have reads have no flag and go with the flag filter, so the full join is a LEFT join.
    """
    return natural_join(missing.filter(F.col(flag)), reads, how="left")


def missing_summary_by_family(missing: DataFrame, key_cols: Sequence[str] = ("higher_taxon", "family")) -> DataFrame:
    """C22 as shipped: every family with its count of missing cells (over all selected columns, D12)."""
    return with_missing_count(missing).select(*key_cols, "n_missing")


def missing_summary_by_order(missing: DataFrame, group: str = "higher_taxon") -> DataFrame:
    """C22 as coded: per order, families with missing attributes and total missing cells, largest first."""
    return missing_by_group(with_missing_count(missing), group)


def family_checklist(taxonomy: DataFrame, family: str = "family") -> DataFrame:
    """``table(taxonomy$Family)``: clusters per family, NA excluded, ascending."""
    return frequency_table(taxonomy, family, value_name=family, count_name="n_clusters")

