from pyspark.sql import functions as F

from conftest import rows
from ecospark.functions import european_double
from ecospark.plans import occurrences as occ
from ecospark.operators import filters, joins, setops
from ecospark.plans import attributes
from ecospark.plans import trait_rules as tr


def test_body_size_fixture(spark):
    raw = spark.createDataFrame([("Coleoptera Carabidae ", "2,5", "18", "r"), ("Heteroptera Miridae", "1", "n/a", "r"),
                                 ("Protura", "0,5", "2", "r")], "taxon string, length_min string, length_max string, "
                                                                  "reference string")
    raw = raw.withColumns({c: european_double(c) for c in ("length_min", "length_max")})
    out = attributes.tidy_body_size(raw)
    assert rows(out, "higher_taxon", "family", "length_min", "length_max") == [
        ("Coleoptera", "Carabidae", 2.5, 18.0), ("Hemiptera", "Miridae", 1.0, None), ("Protura", None, 0.5, 2.0)]
    v1 = attributes.tidy_body_size(raw, attributes.V1)
    assert ("Heteroptera", "Miridae") in [tuple(r) for r in v1.select("higher_taxon", "family").collect()]


def test_feeding_niche_split(spark):
    raw = spark.createDataFrame([("Hymenoptera ", "Braconidae-Alysiinae", "Parasitoid", None),
                                 ("Coleoptera", "Carabidae", "Predator", "Soil"),
                                 ("Coleoptera", "Carabidae", "Predator", "Soil")],
                                "order string, taxon_dyntaxa_2017 string, main_feeding_niche string, "
                                "main_feeding_habitat string")
    out = attributes.tidy_feeding_niche(raw)
    assert rows(out, "higher_taxon", "family", "sub_family") == [("Coleoptera", "Carabidae", None),
                                                                 ("Hymenoptera", "Braconidae", "Alysiinae")]


def test_mites_fixture(spark):
    schema = ("higher_taxon string, family string, length_min string, length_max string, length_1 string, "
              "length_1_5 string, length_5_10 string, length_10 string, main_feeding_niche string, "
              "main_feeding_habitat string, x13 string, comment string, _ord long")
    data = [("Acari, Oribatida", "Achipteriidae", "0.4", "0.6", "x", None, None, None, "S", None, None, None, 1),
            ("Acari, Mesostigmata", "Ascidae", None, None, "x", None, None, None, "P", None, None, None, 2),
            ("Collembola", "Tomoceridae", None, None, None, "x", "x", None, "S", None, None, None, 3),
            ("Collembola", "Onychiuridae", "1", "2", None, None, None, None, "S", None, None, None, 4),
            ("Collembola", "Entomobryidae", None, None, None, None, None, "x", "S", None, None, None, 5)]
    out = attributes.tidy_expert_mites(spark.createDataFrame(data, schema))
    assert rows(out, "higher_taxon", "family", "length_min", "length_max") == [
        ("Collembola", "Entomobryidae", 10.0, None), ("Collembola", "Tomoceridae", 1.0, 5.0),
        ("Mesostigmata", "Ascidae", 1.0, 1.0), ("Oribatida", "Achipteriidae", 0.4, 0.6)]


def test_soil_niche(spark):
    raw = spark.createDataFrame(
        [("Animalia;Arthropoda;Collembola;Poduromorpha;Hypogastruridae_environmental_sample;g;s", "a", "b", "c",
          "x", None, "x", None),
         ("Animalia;Arthropoda;Insecta;Diptera;Muscidae;g;s", "a", "b", "c", "x", None, None, None),
         ("Animalia;Arthropoda;Arachnida;Sarcoptiformes;Acaridae;g;s", "a", "b", "c", None, "x", None, "x"),
         ("Animalia;Chordata;Aves;Passeriformes;Paridae;g;s", "a", "b", "c", "x", None, None, None)],
        "consensus_taconomical_identity string, x6 string, x16 string, all_inclusive string, fungi_feeder string, "
        "plant_feeder string, predator string, parasitoid string")
    out = attributes.tidy_soil_niche(raw)
    assert rows(out) == [("Poduromorpha", "Hypogastruridae", "Predator"),
                         ("Poduromorpha", "Hypogastruridae", "Saprophagous"),
                         ("Sarcoptiformes", "Acaridae", "Saprophagous"), ("Sarcoptiformes", "Acaridae", "Saprophagous")]


def test_occurrence_branches(spark):
    o = spark.createDataFrame([("c1", "Braconidae", "G1", "Insecta"), ("c2", "Carabidae", "G2", "Insecta"),
                               ("c3", None, None, None)], "cluster string, family string, genus string, class string")
    subs = spark.createDataFrame([("Braconidae", None, "G1")], "family string, subfamily string, genus string")
    feeding = spark.createDataFrame([("Braconidae", None, "P"), ("Braconidae", "Alysiinae", "Q"),
                                     ("Carabidae", None, "Predator"), ("Carabidae", "x", "Phytophagous")],
                                    "family string, subfamily string, feeding_niche string")
    out = occ.occurrence_attributes(o, subs, feeding)
    assert set(out.columns) >= {"sub_family", "subfamily", "feeding_niche"}
    assert rows(out, "cluster", "feeding_niche") == [("c1", "P"), ("c2", "Phytophagous"), ("c2", "Predator"),
                                                     ("c3", None)]
    ref = occurrence_attributes_split(o, subs, feeding)
    cols = sorted(ref.columns)
    assert sorted(out.columns) == cols
    assert rows(out, *cols) == rows(ref, *cols)


def test_niche_richness_levels(spark):
    df = spark.createDataFrame(
        [("Predator", 1, 5, "c1"), ("Predator", 1, 5, None), ("Predator", 1, 5, "c1"), ("Parasite", 1, 5, "c2"),
         ("Phytophate-parasitoid", 2, 5, "c3"), (None, 2, 5, "c4")],
        "feeding_niche string, week_year int, trap_id int, cluster string")
    df = df.withColumn("class", F.lit("Insecta")).withColumn("lab_sample_type", F.lit("sample"))
    out = occ.niche_richness(df)
    assert rows(out) == [(None, 2, 5, 1), ("Predator", 1, 5, 2)]


def test_land_larval_sheet(spark, tmp_path):
    # column 29 is dropped, row 1 is the header, data rows 587..602 (after the header) are junk
    header = ["Higher Taxon", "Family", "Note"] + [f"Score {i}" for i in range(4, 29)] + ["Extra"]
    lines = ["Sheet title" + "," * 29, ",".join(header)]
    for i in range(1, 611):
        junk = 587 <= i <= 602
        lines.append(",".join([f"O{i % 3}", "Total" if junk else f"F{i} ", "n"] +
                              [("x" if junk else str((i * s) % 10 / 10)) for s in range(4, 29)] + ["e"]))
    p = tmp_path / "larval.csv"
    p.write_text("\n".join(lines) + "\n")
    sheet = attributes.land_larval_sheet(spark, str(p))
    assert sheet.columns[:4] == ["higher_taxon", "family", "note", "score_4"] and "extra" not in sheet.columns
    assert sheet.count() == 610 - 16
    tidy = attributes.tidy_larval_niche(sheet)
    assert tidy.filter(F.col("family") == "Total").count() == 0
    assert dict(tidy.dtypes)["score_4"] == "double"
    assert rows(tidy.filter(F.col("family") == "F10"), "higher_taxon", "family", "score_5") == [("O1", "F10", 0.0)]


def occurrence_attributes_split(occ, subfamilies, feeding,
                            families=tr.SUBFAMILY_FAMILIES):
    """C18 as three parts that are joined on different keys and put together again: the reference form."""
    sub = filters.filter_in(occ, "family", families)
    sub = joins.left_join(sub, subfamilies, ["family", "genus"])
    sub = joins.left_join(sub, feeding, ["family", "subfamily"])
    rest = filters.filter_not_in(occ, "family", families).withColumn("sub_family", F.lit(None).cast("string"))
    rest = joins.left_join(rest, feeding, ["family"])
    return setops.bind_rows(rest, sub)
