"""The four end-to-end jobs over small raw files in the original formats."""

import os

from conftest import rows
from ecospark.plans import jobs


def _write(d, name, lines):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def _larval_lines():
    scores = ["Saprophagous", "Zoophagous", "Phytophagous", "Larva Aquatic", "Mycetophagous", "Coprophagous",
              "Saproxylic", "Roots"] + [f"Score {i}" for i in range(12, 29)]
    head = ",".join(["Higher Taxon", "Family", "Note"] + scores + ["Extra"])
    def row(ht, fam, vals):
        v = vals + ["0"] * (25 - len(vals))
        return ",".join([ht, fam, "n"] + v + ["e"])
    return ["junk" + "," * 28, head,
            row("Coleoptera", "Carabidae ", ["0.1", "0.9", "0.2", "0", "0", "0", "0", "0"]),
            row("Diptera", "Muscidae", ["0.8", "0", "0", "0", "0", "0.7", "0", "0"]),
            row("Protura", "Acerentomidae", ["0", "0", "0", "0", "0", "0", "0", "0.9"])]


def test_jobs_end_to_end(spark, tmp_path):
    d = str(tmp_path)
    out = os.path.join(d, "out")
    cfg = {
        "out": out,
        "taxonomy": _write(d, "taxa.tsv", ["cluster\tPhylum\tClass\tOrder\tFamily\tGenus",
                                           "c1\tArthropoda\tInsecta\tColeoptera\tCarabidae\tCarabus",
                                           "c2\tArthropoda\tInsecta\tDiptera\tMuscidae\tMusca",
                                           "c3\tArthropoda\tInsecta\tHymenoptera\tBraconidae\tAlysia",
                                           "c4\tChordata\tAves\tPasseriformes\tParidae\tParus",
                                           "c5\tArthropoda\tArachnida\tAraneae\tLycosidae\tPardosa",
                                           "c7\tArthropoda\tArachnida\tOribatida\tAchipteriidae\tAchipteria"]),
        "body_mass": _write(d, "body.csv", ["Taxon;Length Min;Length Max;Reference",
                                            "Coleoptera Carabidae ;2,5;18;r1", "Heteroptera Miridae;1;n/a;r2",
                                            "Protura;0,5;2;r3"]),
        "larval": _write(d, "larval.csv", _larval_lines()),
        "feeding": _write(d, "feeding.csv", ["Order,Taxon Dyntaxa 2017,Main Feeding Niche,Main Feeding Habitat",
                                             "Coleoptera,Carabidae,Predator,Soil",
                                             "Hymenoptera,Braconidae-Alysiinae,Predator-parasitoid,",
                                             "Protura,Acerentomidae,,"]),
        "soil": _write(d, "soil.csv", ["Consensus Taconomical Identity,Fungi Feeder,Plant Feeder,Predator,,All Inclusive",
                                       "Animalia;Arthropoda;Arachnida;Araneae;Lycosidae;g;s,,,x,q,y",
                                       "Animalia;Arthropoda;Insecta;Diptera;Muscidae;g;s,x,,,q,y"]),
        "expert_general": _write(d, "tr.csv", ["Higher Taxon;Family;Length Min;Length Max;Main Feeding Niche By;"
                                               "Main Feeding Habitat By;N Otu;N Obs;Reads;In Checklist",
                                               "Diptera;Muscidae;3;12;Saprophagous;;1;1;1;TRUE"]),
        "expert_spiders": _write(d, "ar.csv", ["Higher Taxon;Family;Length Min;Lenght Max;Main Feeding Niche By;"
                                               "Main Feeding Habitat By", "Araneae;Lycosidae;4;9;Predator;Soil"]),
        "expert_mites": _write(d, "cm.csv", ["Higher Taxon,Family,Length Min,Length Max,Length 1,Length 1 5,Length 5 10,"
                                             "Length 10,Main Feeding Niche By,Main Feeding Habitat By,Comment,"
                                             "Source,", "\"Acari, Oribatida\",Achipteriidae,0.4,0.6,x,,,,Saprophagous,Soil,,s,"]),
    }
    cfg["renames"] = {"main_feeding_niche_by": "main_feeding_niche", "main_feeding_habitat_by": "main_feeding_habitat"}
    all_attributes = jobs.trait_job(spark, cfg)
    at = {(r.higher_taxon, r.family): r for r in all_attributes.collect()}
    assert at[("Coleoptera", "Carabidae")].length_min == 2.5 and at[("Coleoptera", "Carabidae")].in_checklist
    assert at[("Coleoptera", "Carabidae")].main_feeding_niche == "Predator"
    assert at[("Hemiptera", "Miridae")].in_checklist is False
    assert at[("Diptera", "Muscidae")].length_min == 3.0                       # patched from the general table
    assert at[("Diptera", "Muscidae")].main_feeding_habitat == "Temporary habitats"  # coprophagous rule
    assert at[("Araneae", "Lycosidae")].length_max == 9.0                      # spiders table (lenght_max)
    assert at[("Protura", "Acerentomidae")].length_min == 0.5                  # back-filled within Protura
    assert at[("Oribatida", "Achipteriidae")].length_max == 0.6                # mites table, only for a listed key
    assert ("Mesostigmata", "Ascidae") not in at                               # unmatched patch rows are ignored
    assert os.path.isdir(os.path.join(out, "all_attributes.csv"))

    v1 = {(r.higher_taxon, r.family): r for r in jobs.trait_job_v1(spark, dict(cfg, out=os.path.join(d, "v1"))).collect()}
    assert ("Heteroptera", "Miridae") in v1                                    # not recoded in the older recipe
    assert ("Passeriformes", "Paridae") in v1                                  # no phylum filter

    occ_cfg = {
        "out": out, "all_attributes": os.path.join(out, "all_attributes.parquet"),
        "taxonomy": _write(d, "otu_taxa.tsv", ["cluster\tphylum\tclass\torder\tfamily\tgenus",
                                               "c1\tArthropoda\tInsecta\tColeoptera\tCarabidae\tCarabus",
                                               "c3\tArthropoda\tInsecta\tHymenoptera\tBraconidae\tAlysia",
                                               "c4\tChordata\tAves\tPasseriformes\tParidae\tParus"]),
        "clusters": _write(d, "counts.tsv", ["cluster\tP1_1\tP1_2", "c1\t5\t0", "c3\t2\t7", "c4\t9\t9"]),
        "seq_meta": _write(d, "seq.tsv", ["sampleID_NGI\tlab_sample_type\tsampleID_FIELD",
                                          "P1_1\tsample\tf1", "P1_2\tsample\tf2"]),
        "malaise_meta": _write(d, "mal.tsv", ["sampleID_FIELD\ttrapID\tcollecting_date",
                                              "f1\tT1\t01/07/2019", "f2\tT1\t09/07/2019"]),
        "trap_meta": _write(d, "traps.tsv", ["trapID\tlatitude\tlongitude", "T1\t59.1\t18.2", "T2\t60\t17"]),
        "classification": os.path.join(d, "class.parquet"),
    }
    spark.createDataFrame([(1, "Braconidae", "family", 10), (1, "Alysiinae", "subfamily", 11),
                           (1, "Alysia", "genus", 12)], "taxon_key int, name string, rank string, id int") \
        .write.parquet(occ_cfg["classification"])
    rich = jobs.occurrence_job(spark, occ_cfg)
    # Carabidae by family; Braconidae through its genus -> sub-family -> (family, sub-family) niche
    assert rows(rich) == [("Predator", 26, "T1", 1), ("Predator-parasitoid", 26, "T1", 1),
                          ("Predator-parasitoid", 28, "T1", 1)]

    sum_cfg = {
        "out": out, "all_attributes": os.path.join(out, "all_attributes.parquet"),
        "taxonomy": _write(d, "sum_taxa.tsv", ["ASV\tPhylum\tOrder\tFamily",
                                               "c1\tArthropoda\tColeoptera\tCarabidae",
                                               "c2\tArthropoda\tDiptera\tMuscidae",
                                               "c6\tArthropoda\tDiptera\tMuscidae"]),
        "clusters": _write(d, "sum_counts.tsv", ["cluster\tS1\tS2", "c1\t10\t0", "c2\t3\t4", "c6\t0\t1"]),
        "seq_meta": _write(d, "sum_seq.tsv", ["sampleID_LAB\tsampleID_FIELD", "S1\tf1", "S2\tf2"]),
        "malaise_meta": _write(d, "sum_mal.tsv", ["sampleID_FIELD\ttrapID", "f1\tT1", "f2\tT2"]),
    }
    seq = jobs.summary_job(spark, sum_cfg)
    got = {r.Family: (r.n_otu, r.n_obs, r.reads) for r in seq.collect()}
    assert got.get("Muscidae", (None,))[0] in (None, 2)
    reads = {r.Family: r for r in spark.read.option("header", True).csv(os.path.join(out, "missing_attributes_summary.csv"))
             .collect()}
    assert reads["Carabidae"].n_missing == "0" and reads["Miridae"].n_missing == "3"

    fams = jobs.checklist_job(spark, {"out": out, "taxonomy": sum_cfg["taxonomy"]})
    assert [tuple(r) for r in fams.collect()] == [("Carabidae", 1), ("Muscidae", 2)]


def test_example_configs_name_every_input():
    import json
    import re
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples")
    src = open(os.path.join(os.path.dirname(jobs.__file__), "jobs.py")).read()
    for job, fn in [("attributes", "trait_job"), ("attributes_v1", "trait_job_v1"), ("occurrences", "occurrence_job"),
                    ("summaries", "summary_job"), ("checklist", "checklist_job")]:
        body = src[src.index(f"def {fn}("):]
        body = body[:body.index("\ndef ", 1)] if "\ndef " in body[1:] else body
        used = set(re.findall(r'cfg\["([a-z_]+)"\]', body)) | {"out"}
        cfg = json.load(open(os.path.join(root, f"{job}.json")))
        assert used == set(cfg), (job, used ^ set(cfg))


def test_cli_rejects_bad_arguments(capsys):
    assert jobs.main([]) == 2
    assert jobs.main(["nope", "cfg.json"]) == 2
    assert "python -m ecospark.plans.jobs" in capsys.readouterr().out
