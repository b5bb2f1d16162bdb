"""Occurrence assembly (C13-C19): wide count matrix + taxonomy + sampling metadata + attributes -> weekly
richness per feeding niche.

Scale: the count matrix is the only large input.  It is turned long with zero cells dropped *before* the
explode (``explode_wide``), filtered, and only then joined; lookups and metadata are per-sample /
per-family tables that Spark broadcasts when their measured size allows and shuffles otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark import functions as ef
from ecospark.operators import columns, filters, joins, reshape
from ecospark.operators.distinct import distinct_counts
from ecospark.plans import trait_rules as tr
from ecospark.session import materialize

META_COLUMNS = "sample_id_ngi|trap|type|date|lat|lon"


def read_counts_long(taxonomy: DataFrame, counts: DataFrame, *, wide: bool = True, cluster: str = "cluster",
                     sample: str = "sample_id_ngi", value: str = "read_count",
                     phylum: str = tr.ARTHROPOD_PHYLUM) -> DataFrame:
    """The counts above zero of one phylum's clusters as long rows with their taxonomy, sample ids restored.

    The phylum filter removes every count row without taxonomy, so the join is an inner join on the filtered
    taxonomy, and the count filter runs inside the explode.
    """
    if wide:
        # sample ids are column headers: fix them once per column, not once per long row
        long = reshape.explode_wide(counts, [cluster], None, sample, value, keep=lambda v: v > 0,
                                    rename=lambda c: re.sub("p", "P", c, count=1))
    else:
        long = counts.select(cluster, ef.replace_first(sample, "p", "P").alias(sample), value) \
            .filter(F.col(value) > 0)
    taxa = taxonomy.filter(F.col("phylum") == F.lit(phylum))
    return joins.join(taxa, long, [cluster], "inner")


def sample_meta(seq_meta: DataFrame, malaise_meta: DataFrame, trap_meta: DataFrame,
                select_regex: str = META_COLUMNS) -> DataFrame:
    """C14: natural full joins of the three metadata tables, regex column selection, lubridate week.

    Nothing guarantees that the ids are unique or present, so the joins take the form that AQE can split.
    """
    m = joins.natural_join(seq_meta, malaise_meta, how="full")
    m = joins.natural_join(m, trap_meta, how="full")
    m = columns.select_matching(m, select_regex)
    return m.withColumn("week_year", ef.block_week(ef.parse_dmy("collecting_date")))


def occurrences(counts_long: DataFrame, meta: DataFrame) -> DataFrame:
    """Natural full join of counts and metadata (metadata-only rows survive, D18).

    The full join reads the counts twice (all rows, and the keys for the rows that only the metadata has), so the
    long counts are written once to the shared folder first."""
    return joins.natural_join(materialize(counts_long, "counts-long"), meta, how="full", strategy="marked")


def feeding_lookup(all_attributes: DataFrame) -> DataFrame:
    """(family, subfamily, feeding_niche) from the trait table, family present, distinct."""
    lk = columns.select_renamed(all_attributes, ["family", ("subfamily", "sub_family"),
                                             ("feeding_niche", "main_feeding_niche")])
    return filters.drop_na(lk, ["family"]).distinct()


def subfamily_lookup(classification: DataFrame, ranks: Sequence[str] = tr.CLASSIFICATION_RANKS) -> DataFrame:
    """C17 (G1, G2): long classification (taxon_key, name, rank, id) -> one row per taxon with a column per
    rank.  The per-taxon loop of the original is a single grouped pivot; taxa without any of the ranks simply
    produce no row."""
    kept = filters.filter_in(classification, "rank", ranks).drop("id").distinct()
    kept = kept.filter(F.col("name").isNotNull())
    wide = reshape.pivot_fixed(kept, ["taxon_key"], "rank", "name", list(ranks))
    return wide.drop("taxon_key")


def occurrence_attributes(occ: DataFrame, subfamilies: DataFrame, feeding: DataFrame,
                      families: Sequence[str] = tr.SUBFAMILY_FAMILIES) -> DataFrame:
    """Three families get attributes by (family, subfamily) after a (family, genus) sub-family lookup; all
    others (NA family included) by family alone, fanning out over the family's niches (D14).

    The original splits the table, joins each part on different keys and binds the rows back.  Here it is one
    pass: every occurrence row belongs to exactly one branch, so two conditional LEFT joins give the same rows
    while the (large) occurrence table is scanned and shuffled once instead of once per branch.
    """
    # the lookups are written first: their size is known when the join is planned, and the large table is not shuffled
    # for a side that turns out to be small
    subfamilies, feeding = materialize(subfamilies, "subfamilies"), materialize(feeding, "feeding")
    o = occ.withColumn("__special", ef.is_in("family", families))
    s = subfamilies.select(F.col("family").alias("__s_family"), F.col("genus").alias("__s_genus"),
                           F.col("subfamily").alias("__s_sub"))
    o = o.join(s, o["family"].eqNullSafe(s["__s_family"]) & o["genus"].eqNullSafe(s["__s_genus"]) & o["__special"],
               "left")
    # the second key is the sub-family in the special families and NULL elsewhere, on both sides: one equality join,
    # and a special family is spread over its sub-families
    o = o.withColumn("__sub", F.when(F.col("__special"), F.col("__s_sub")))
    f = feeding.select(F.col("family").alias("__f_family"), F.col("subfamily").alias("__f_sub"),
                       F.when(ef.is_in("family", families), F.col("subfamily")).alias("__f_key"), F.col("feeding_niche"))
    j = o.join(f, o["family"].eqNullSafe(f["__f_family"]) & o["__sub"].eqNullSafe(f["__f_key"]), "left")
    return j.select(*occ.columns, F.lit(None).cast("string").alias("sub_family"),
                    F.when(F.col("__special"), F.col("__s_sub")).otherwise(F.col("__f_sub")).alias("subfamily"),
                    "feeding_niche")


def niche_richness(all_data: DataFrame, levels: Sequence[str] = tr.NICHE_LEVELS,
                   exclude: str = tr.NICHE_EXCLUDE, insect_class: str = "Insecta") -> DataFrame:
    """Distinct clusters (NA counted) per (feeding niche, week, trap) for insect samples; niches matching
    ``exclude`` removed; values outside ``levels`` become NA (rows kept)."""
    df = all_data.filter((F.col("class") == F.lit(insect_class)) & (F.col("lab_sample_type") == F.lit("sample")))
    g = distinct_counts(df, ["feeding_niche", "week_year", "trap_id"], {"n_OTU": "cluster"})
    g = filters.drop_na(g, ["feeding_niche"])
    g = g.filter(~ef.detect("feeding_niche", exclude))
    # report order of the grouped summary (group keys ascending, NA last); the result is small
    g = g.orderBy(*[F.asc_nulls_last(c) for c in ("feeding_niche", "week_year", "trap_id")])
    return g.withColumn("feeding_niche", ef.as_level("feeding_niche", levels))
