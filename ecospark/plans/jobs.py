"""End-to-end jobs over the raw source files: what the original scripts do when run.

Each job reads its inputs with the matching reader, runs the recipes, and writes its outputs.  Hand-offs
between jobs (the compiled trait table read by the occurrence and summary jobs) are parquet tables in the
output folder, which on a cluster must be a shared location.

    python -m ecospark.plans.jobs attributes      config.json
    python -m ecospark.plans.jobs attributes_v1   config.json
    python -m ecospark.plans.jobs occurrences config.json
    python -m ecospark.plans.jobs summaries   config.json
    python -m ecospark.plans.jobs checklist   config.json

The config maps input names (see each job) to paths, plus ``out`` (output folder).
"""

from __future__ import annotations

import json
import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecospark.operators import columns, joins
from ecospark.plans import occurrences as occ
from ecospark.plans import summaries, attributes
from ecospark.sources import delimited, sinks


def _out(cfg: Mapping[str, str], name: str) -> str:
    return f"{cfg['out'].rstrip('/')}/{name}"


def _sheet(spark: SparkSession, path: str) -> DataFrame:
    """A spreadsheet sheet landed as CSV: readr-style NA handling, cleaned headers, file order in ``_ord``."""
    df = delimited.read_csv(spark, path, clean=True)
    return delimited.with_row_number(df, "_ord")


def _renamed(cfg: Mapping, df: DataFrame) -> DataFrame:
    """``df`` with the foreign headers that the config's optional ``renames`` maps (cleaned name -> name used here)."""
    return df.withColumnsRenamed(dict(cfg.get("renames", {})))


def trait_job(spark: SparkSession, cfg: Mapping[str, str]) -> DataFrame:
    """Trait compilation (C1-C12).  Inputs: taxonomy (TSV), body_mass (;-CSV), feeding (sheet), larval (sheet
    with the header in its first row), soil (sheet), expert_general (;-CSV), expert_spiders (;-CSV),
    expert_mites (sheet); ``renames`` maps foreign headers of the expert tables.  Outputs: all_attributes (parquet + CSV), missing_lh, missing_patterns,
    complete_families."""
    taxonomy = columns.clean_columns(delimited.read_tsv(spark, cfg["taxonomy"]))
    body = attributes.tidy_body_size(
        delimited.with_row_number(delimited.read_csv2(spark, cfg["body_mass"], numeric=["length_min", "length_max"]),
                                  "_ord"))
    larval = attributes.tidy_larval_niche(attributes.land_larval_sheet(spark, cfg["larval"]))
    feeding = attributes.tidy_feeding_niche(_sheet(spark, cfg["feeding"]))
    soil = attributes.tidy_soil_niche(_sheet(spark, cfg["soil"]))
    experts = [
        attributes.tidy_expert_general(_renamed(cfg, delimited.read_csv2(spark, cfg["expert_general"]))),
        attributes.tidy_expert_mites(_renamed(cfg, _sheet(spark, cfg["expert_mites"]))),
        attributes.tidy_expert_spiders(_renamed(cfg, delimited.read_csv2(spark, cfg["expert_spiders"]))),
    ]
    all_attributes = attributes.compile_attributes(body, larval, feeding, soil, taxonomy, experts)
    # hand-off table, read back by everything downstream (cuts the lineage of the compilation)
    all_attributes = sinks.handoff(all_attributes, _out(cfg, "all_attributes.parquet"))
    sinks.write_csv_r(all_attributes, _out(cfg, "all_attributes.csv"), _row_order(all_attributes))
    missing = attributes.missing_life_history(all_attributes)
    sinks.write_csv_r(missing, _out(cfg, "missing_lh.csv"), _row_order(missing))
    sinks.write_table(attributes.trait_missing_patterns(all_attributes), _out(cfg, "missing_patterns.parquet"))
    sinks.write_table(attributes.complete_case_families(all_attributes), _out(cfg, "complete_families.parquet"))
    return all_attributes


def _row_order(df: DataFrame) -> list:
    """The order of a written table: its text columns from the left, then the others, missing values last."""
    text = [c for c, t in df.dtypes if t == "string"]
    return [F.asc_nulls_last(c) for c in [*text, *[c for c in df.columns if c not in text]]]


def trait_job_v1(spark: SparkSession, cfg: Mapping[str, str]) -> DataFrame:
    """The older trait compilation (C24): taxonomy (TSV), body_mass (;-CSV), feeding (sheet), larval (sheet);
    no soil or expert tables, no phylum filter, keys trimmed after the joins.  Output: all_attributes_v1."""
    recipe = attributes.V1
    taxonomy = columns.clean_columns(delimited.read_tsv(spark, cfg["taxonomy"]))
    body = attributes.tidy_body_size(
        delimited.with_row_number(delimited.read_csv2(spark, cfg["body_mass"], numeric=["length_min", "length_max"]),
                                  "_ord"), recipe)
    larval = attributes.tidy_larval_niche(attributes.land_larval_sheet(spark, cfg["larval"]), recipe)
    feeding = attributes.tidy_feeding_niche(_sheet(spark, cfg["feeding"]), recipe)
    out = attributes.compile_attributes(body, larval, feeding, None, taxonomy, [], recipe)
    out = sinks.handoff(out, _out(cfg, "all_attributes_v1.parquet"))
    sinks.write_csv_r(out, _out(cfg, "all_attributes_v1.csv"), _row_order(out))
    return out


def occurrence_job(spark: SparkSession, cfg: Mapping[str, str]) -> DataFrame:
    """Occurrence assembly (C13-C19).  Inputs: taxonomy, clusters (wide counts), seq_meta, malaise_meta,
    trap_meta (all tab-separated, read like ``fread``), all_attributes (parquet hand-off), classification
    (parquet: taxon_key, name, rank, id).  Outputs: occurrence_attributes, niche_richness (parquet)."""
    taxonomy = delimited.read_fread(spark, cfg["taxonomy"])
    counts = delimited.read_wide_counts(spark, cfg["clusters"], "cluster", "sample_id_ngi", clean=True)
    long = occ.read_counts_long(taxonomy, counts, wide=False)
    meta = occ.sample_meta(delimited.read_fread(spark, cfg["seq_meta"]),
                           delimited.read_fread(spark, cfg["malaise_meta"]),
                           delimited.read_fread(spark, cfg["trap_meta"]))
    o = occ.occurrences(long, meta)
    all_attributes = spark.read.parquet(cfg["all_attributes"])
    subs = occ.subfamily_lookup(spark.read.parquet(cfg["classification"]))
    all_data = occ.occurrence_attributes(o, subs, occ.feeding_lookup(all_attributes))
    all_data = sinks.handoff(all_data, _out(cfg, "occurrence_attributes.parquet"))
    richness = occ.niche_richness(all_data)
    sinks.write_table(richness, _out(cfg, "niche_richness.parquet"))
    return richness


def summary_job(spark: SparkSession, cfg: Mapping[str, str], trap: str = "trapID",
                sample: str = "sampleID_LAB") -> DataFrame:
    """Reads and samples per family joined to the missing-trait report (C20-C22).  Inputs: all_attributes
    (parquet), taxonomy (TSV, first column = cluster), clusters (TSV, wide), seq_meta, malaise_meta (TSV).
    Outputs: missing_attributes_seq.csv, missing_attributes_summary.csv (per family, as shipped) and
    missing_attributes_by_order.csv (as coded)."""
    taxonomy = columns.rename_ordinal(delimited.read_tsv(spark, cfg["taxonomy"]), 1, "cluster")
    counts = delimited.read_wide_counts(spark, cfg["clusters"], "cluster", sample)
    meta = joins.natural_join(delimited.read_tsv(spark, cfg["seq_meta"]),
                              delimited.read_tsv(spark, cfg["malaise_meta"]))
    meta = columns.select_matching(meta, ["sampleID", "trap"])
    reads = summaries.family_reads(counts, taxonomy.withColumnRenamed("Family", "family"), meta, sample=sample,
                                   reads="read_count", trap=trap, sort=False).withColumnRenamed("family", "Family")
    all_attributes = spark.read.parquet(cfg["all_attributes"]).withColumnRenamed("family", "Family")
    missing = summaries.missing_attributes(all_attributes, key_cols=("higher_taxon", "Family"), flag="in_checklist")
    seq = summaries.missing_attributes_seq(missing, reads, flag="in_checklist")
    sinks.write_csv_r(seq, _out(cfg, "missing_attributes_seq.csv"), _row_order(seq))
    # as shipped (D2): every family, zero-missing ones included, so counted on the unfiltered selection
    report = all_attributes.select("higher_taxon", "Family", *summaries.TRAIT_REPORT_COLS, "in_checklist")
    by_family = summaries.missing_summary_by_family(report, ("higher_taxon", "Family"))
    sinks.write_csv_r(by_family, _out(cfg, "missing_attributes_summary.csv"), _row_order(by_family))
    by_order = summaries.missing_summary_by_order(missing)
    sinks.write_csv_r(by_order, _out(cfg, "missing_attributes_by_order.csv"),
                      [F.desc_nulls_last(by_order.columns[1]), F.asc_nulls_last(by_order.columns[0])])
    return seq


def checklist_job(spark: SparkSession, cfg: Mapping[str, str]) -> DataFrame:
    """Family checklist (C23).  Input: taxonomy (TSV, first column = cluster).  Output: families.csv."""
    taxonomy = columns.rename_ordinal(delimited.read_tsv(spark, cfg["taxonomy"]), 1, "cluster")
    out = summaries.family_checklist(taxonomy, "Family")
    sinks.write_csv_r(out, _out(cfg, "families.csv"), order_by=["Family"])
    return out


JOBS = {"attributes": trait_job, "attributes_v1": trait_job_v1, "occurrences": occurrence_job, "summaries": summary_job,
        "checklist": checklist_job}


def main(argv: list[str]) -> int:
    from ecospark.session import drop_materialized, get_spark

    if len(argv) != 2 or argv[0] not in JOBS:
        print(__doc__)
        return 2
    with open(argv[1]) as f:
        cfg = json.load(f)
    spark = get_spark()
    try:
        JOBS[argv[0]](spark, cfg)
    finally:
        drop_materialized(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
