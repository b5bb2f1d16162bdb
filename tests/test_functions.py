import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from ecospark import functions as ef
from ecospark.plans import trait_rules as tr


def test_replace_first_only(spark):
    df = spark.createDataFrame([("p1_pp",), ("xyz",), (None,)], "s string")
    assert rows(df.select(ef.replace_first("s", "p", "P").alias("s"))) == [(None,), ("P1_pp",), ("xyz",)]


def test_replace_first_keeps_dot_semantics(spark):
    df = spark.createDataFrame([("a\nb,c, d",)], "s string")
    # '.' does not cross the newline, like the R default
    assert df.select(ef.remove_first("s", r".*,\s").alias("s")).first().s == "a\nb,c, d".replace("b,c, ", "")


def test_extract_and_split(spark):
    df = spark.createDataFrame([("Braconidae-Alysiinae",), ("Carabidae",), (None,)], "f string")
    out = df.select(ef.extract_first("f", "([^-])+").alias("family"), ef.nth_piece("f", "-", 2).alias("sub"))
    assert rows(out) == [(None, None), ("Braconidae", "Alysiinae"), ("Carabidae", None)]


def test_extract_lookbehind_and_no_match(spark):
    df = spark.createDataFrame([("Coleoptera_Carabidae",), ("Protura",)], "t string")
    out = df.select(ef.extract_first("t", "^([^_]+)").alias("h"), ef.extract_first("t", "(?<=_)[^_]+").alias("f"))
    assert rows(out) == [("Coleoptera", "Carabidae"), ("Protura", None)]


def test_rtrim_unicode(spark):
    df = spark.createDataFrame([(" Carabidae  \t",)], "s string")
    assert df.select(ef.rtrim_unicode("s").alias("s")).first().s == " Carabidae"


def test_dates_and_block_week(spark):
    vals = ["01/01/2019", "07/01/2019", "08/01/2019", "24/06/2019", "31/12/2019", "bad", "31/02/2019",
            "5/3/2019 extra"]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    out = df.select("d", ef.parse_dmy("d").alias("date"), ef.block_week(ef.parse_dmy("d")).alias("w")).collect()
    got = {r.d: (r.date, r.w) for r in out}
    assert [got[v][1] for v in vals[:6]] == [1, 1, 2, 25, 53, None]
    assert got["31/02/2019"] == (None, None)
    assert got["5/3/2019 extra"][0] == dt.date(2019, 3, 5)


def test_lenient_and_european_numbers(spark):
    df = spark.createDataFrame([("2,5",), ("1.234,5",), ("n/a",), (None,), ("18",)], "s string")
    assert rows(df.select(ef.european_double("s").alias("x"))) == [(None,), (None,), (2.5,), (18.0,), (1234.5,)]
    df2 = spark.createDataFrame([(" 12 ",), ("1.0d",), ("1e3",), ("abc",)], "s string")
    assert rows(df2.select(ef.lenient_double("s").alias("x"))) == [(None,), (None,), (12.0,), (1000.0,)]


def test_in_not_in_null_contract(spark):
    df = spark.createDataFrame([("Protura",), ("Diptera",), (None,)], "h string")
    assert rows(df.filter(ef.is_in("h", ["Protura"]))) == [("Protura",)]
    assert rows(df.filter(ef.not_in("h", ["Protura"]))) == [(None,), ("Diptera",)]
    assert rows(df.filter(ef.is_in("h", ["Protura", None]))) == [(None,), ("Protura",)]


def test_recode(spark):
    df = spark.createDataFrame([("Heteroptera",), ("Coleoptera",), (None,)], "h string")
    out = df.select(ef.recode("h", tr.HIGHER_TAXON_SYNONYMS).alias("h"))
    assert rows(out) == [(None,), ("Coleoptera",), ("Hemiptera",)]


def test_threshold_fill_first_rule_wins_and_wood_unreachable(spark):
    df = spark.createDataFrame(
        [(None, 0.6, 0.9, 0.0, None, 0.0, 0.0, 0.0, 0.0, 0.0),
         (None, 0.0, 0.0, 0.9, None, 0.0, 0.0, 0.0, 0.9, 0.0),
         ("Predator", 0.9, 0.0, 0.0, "Water", 0.0, 0.0, 0.0, 0.0, 0.0)],
        "n string, saprophagous double, zoophagous double, phytophagous double, h string, larva_aquatic double, "
        "mycetophagous double, coprophagous double, saproxylic double, roots double")
    out = df.select(ef.threshold_fill("n", tr.NICHE_FILL).alias("n"), ef.threshold_fill("h", tr.HABITAT_FILL).alias("h"))
    assert rows(out) == [("Phytophagous", "Plants"), ("Predator", "Water"), ("Saprophagous", None)]


def test_regex_category_no_default(spark):
    names = ["fungi_x", "plant_y", "predator_z", "parasitic_w", "parasitoid_v"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    out = {r.n: r.c for r in df.select("n", ef.regex_category("n", tr.SOIL_NICHE_CATEGORIES).alias("c")).collect()}
    assert [out[n] for n in names] == ["Saprophagous", "Phytophagous", "Predator", "Parasite", None]


def test_levels_and_exclusion(spark):
    vals = ["Predator", "Parasite", "General", "Phytophage-parasitoid", "Phytophate-parasitoid"]
    df = spark.createDataFrame([(v,) for v in vals], "n string")
    out = df.filter(~ef.detect("n", tr.NICHE_EXCLUDE)).select(ef.as_level("n", tr.NICHE_LEVELS).alias("n"),
                                                              ef.level_index("n", tr.NICHE_LEVELS).alias("i"))
    assert rows(out) == [(None, None), ("Phytophage-parasitoid", 4), ("Predator", 2)]


def test_distinct_with_null(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,)], "x int")
    assert df.agg(ef.distinct_with_null("x").alias("n")).first().n == 3
    assert df.agg(F.count_distinct("x").alias("n")).first().n == 2


def test_one_meaning_of_missing(spark):
    from ecospark.functions import fold_missing, lenient_double
    from ecospark.operators import aggregates, filters

    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1, 1.0, "a"), (2, nan, "NaN"), (3, None, "c"), (4, inf, None)], "k int, x double, t string")
    assert [r.k for r in filters.drop_na(df).collect()] == [1]
    assert [r.k for r in filters.drop_na(df, ["x"]).collect()] == [1, 4]
    assert [r.k for r in filters.drop_na_except(df, ["x"]).collect()] == [1, 2, 3]
    assert sorted(r.k for r in filters.keep_any_missing(df, ["x", "t"]).collect()) == [2, 3, 4]
    assert [r.n_missing for r in aggregates.with_missing_count(df).orderBy("k").collect()] == [0, 1, 1, 1]
    assert sorted((r.x, r.t, r.n) for r in aggregates.missing_patterns(df, ["x", "t"]).collect()) == \
        [(False, False, 1), (False, True, 1), (True, False, 2)]
    assert aggregates.missing_share(df, ["x", "t"]).first() == (0.5, 0.25)
    assert [r.x for r in fold_missing(df).orderBy("k").collect()] == [1.0, None, None, None]
    texts = spark.createDataFrame([("1e999",), ("-1e999",), ("1e3",)], "s string")
    assert [r[0] for r in texts.select(lenient_double("s")).collect()] == [None, None, 1000.0]
