"""Quirks of the original kept on purpose."""

from pyspark.sql import functions as F

from conftest import rows
from ecospark.plans import occurrences as occ
from ecospark.plans import summaries, attributes

SCORES = ["saprophagous", "zoophagous", "phytophagous", "larva_aquatic", "mycetophagous", "coprophagous",
          "saproxylic", "roots"]


def _sources(spark, rows_):
    body = spark.createDataFrame([(h, f, 1.0, 2.0, "r", i) for i, (h, f) in enumerate(rows_)],
                                 "higher_taxon string, family string, length_min double, length_max double, "
                                 "mass_reference string, _ord long")
    larval = spark.createDataFrame([], "higher_taxon string, family string, " + ", ".join(f"{s} double" for s in SCORES)
                                   + ", _ord long")
    feeding = spark.createDataFrame([(h, f, None, None, None, i) for i, (h, f) in enumerate(rows_)],
                                    "higher_taxon string, family string, sub_family string, "
                                    "main_feeding_niche string, main_feeding_habitat string, _ord long")
    return body, larval, feeding


def test_d4_aranea_rule_does_not_fire_for_araneae(spark):
    body, larval, feeding = _sources(spark, [("Araneae", "Lycosidae"), ("Aranea", "Salticidae")])
    merged = attributes.merge_sources(body, larval, feeding, None)
    got = {r.family: r.main_feeding_niche for r in merged.collect()}
    assert got == {"Lycosidae": None, "Salticidae": "Predators"}


def test_d17_isotomidae_reassigned_before_checklist_join(spark):
    body, larval, feeding = _sources(spark, [("Poduromorpha", "Isotomidae")])
    taxonomy = spark.createDataFrame([("Arthropoda", "Collembola", "Entomobryomorpha", "Isotomidae")],
                                     "phylum string, class string, order string, family string")
    out = attributes.compile_attributes(body, larval, feeding, None, taxonomy)
    assert rows(out, "higher_taxon", "family", "class", "in_checklist") == [
        ("Entomobryomorpha", "Isotomidae", "Collembola", True)]


def test_d13_family_totals_repeat_over_duplicate_keys(spark):
    missing = spark.createDataFrame([("Hymenoptera", "Ichneumonidae", None, True),
                                     ("Hymenoptera", "Ichneumonidae", None, True)],
                                    "higher_taxon string, family string, length_min double, in_checklist boolean")
    reads = spark.createDataFrame([("Ichneumonidae", 3743, 199, 51514066)],
                                  "family string, n_otu long, n_obs long, reads long")
    seq = summaries.missing_attributes_seq(missing, reads, flag="in_checklist")
    assert seq.count() == 2 and seq.agg(F.sum("reads")).first()[0] == 2 * 51514066


def test_d18_metadata_only_rows_survive(spark):
    counts = spark.createDataFrame([("c1", "Carabidae", "P1", 5)],
                                   "cluster string, family string, sample_id_ngi string, read_count long")
    meta = spark.createDataFrame([("P1", "T1"), ("P2", "T2")], "sample_id_ngi string, trap_id string")
    o = occ.occurrences(counts, meta)
    assert rows(o, "sample_id_ngi", "family", "trap_id") == [("P1", "Carabidae", "T1"), ("P2", None, "T2")]


def test_uncleaned_taxonomy_headers_still_join_on_family(spark):
    body, larval, feeding = _sources(spark, [("Coleoptera", "Carabidae")])
    taxonomy = spark.createDataFrame([("Arthropoda", "Insecta", "Coleoptera", "Carabidae")],
                                     "Phylum string, Class string, Order string, Family string")
    out = attributes.compile_attributes(body, larval, feeding, None, taxonomy)
    assert rows(out, "higher_taxon", "family", "class", "in_checklist") == [("Coleoptera", "Carabidae", "Insecta", True)]
