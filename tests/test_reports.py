"""Report computations (C21, C22, A10) on rows shaped like the shipped missing-trait report (FIXTURES.md A)."""

from pyspark.sql import functions as F

from conftest import rows
from ecospark.operators import aggregates
from ecospark.plans import summaries

COLS = "higher_taxon string, family string, length_min double, length_max double, " \
       "main_feeding_niche string, main_feeding_habitat string, in_checklist boolean"


def test_sample_rows(spark):
    at = spark.createDataFrame([("Blattodea", "Blaberidae", 2.5, 75.0, None, None, True),
                                ("Hymenoptera", "Ichneumonidae", 3.0, 40.0, "Predator", None, True),
                                ("Coleoptera", "Carabidae", 2.0, 30.0, "Predator", "Soil", True)], COLS)
    by_family = summaries.missing_summary_by_family(at)
    assert rows(by_family) == [("Blattodea", "Blaberidae", 2), ("Coleoptera", "Carabidae", 0),
                               ("Hymenoptera", "Ichneumonidae", 1)]
    missing = summaries.missing_attributes(at, flag="in_checklist")
    assert rows(missing, "family") == [("Blaberidae",), ("Ichneumonidae",)]
    reads = spark.createDataFrame([("Blaberidae", 1, 1, 10), ("Ichneumonidae", 3743, 199, 51514066)],
                                  "family string, n_otu long, n_obs long, reads long")
    seq = summaries.missing_attributes_seq(missing, reads, flag="in_checklist")
    assert rows(seq, "family", "n_otu", "n_obs", "reads") == [("Blaberidae", 1, 1, 10),
                                                             ("Ichneumonidae", 3743, 199, 51514066)]


def test_pattern_frequencies(spark):
    # missing flags (length_min, length_max, niche, habitat) and how often each occurs in the shipped report
    patterns = {(1, 1, 1, 1): 304, (1, 1, 0, 0): 56, (0, 0, 1, 1): 7, (0, 0, 0, 1): 5, (1, 1, 0, 1): 1}
    data = []
    for (a, b, c, d), n in patterns.items():
        for i in range(n):
            data.append((f"O{i % 84}", f"F{len(data)}", None if a else 1.0, None if b else 2.0,
                         None if c else "Predator", None if d else "Soil", True))
    at = spark.createDataFrame(data, COLS)
    got = aggregates.missing_patterns(at, ["length_min", "length_max", "main_feeding_niche",
                                           "main_feeding_habitat"])
    as_int = {tuple(int(x) for x in r[:4]): r.n for r in got.collect()}
    assert as_int == patterns
    assert at.count() == 373
    by_order = summaries.missing_summary_by_order(summaries.missing_attributes(at, flag="in_checklist"))
    assert by_order.agg(F.sum("n_missing_families")).first()[0] == 373
    # every missing cell is counted once: 304*4 + 56*2 + 7*2 + 5 + 1*3
    assert by_order.agg(F.sum("total_missing_attributes")).first()[0] == 304 * 4 + 56 * 2 + 7 * 2 + 5 + 3
