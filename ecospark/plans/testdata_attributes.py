"""Raw-shaped trait sources derived from the test data, for the composite queries.

Every source is a per-key table (one row, or a bounded handful of rows, per (order, family)), as the real
spreadsheets are; the values exercise the recipe: synonym spellings that only meet after recoding, trailing
blanks, junk numbers, European decimals, composite 'Family-Subfamily' names, ';'-joined taxonomies, and
orders that are back-filled.  ``SOURCES_SQL`` builds the same tables in DuckDB for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecospark import functions as ef
from ecospark.plans import testdata as td

# Fixed values of the analogue: brands stand in for orders (some of them under their real names so that the back-fill,
# synonym and override rules fire); the body-size and larval tables spell some orders the old way.
ORDER_NAMES = {"Brand#1": "Protura", "Brand#2": "Siphonaptera", "Brand#3": "Raphidioptera", "Brand#4": "Strepsiptera",
               "Brand#5": "Hemiptera", "Brand#6": "Blattodea", "Brand#7": "Aranea", "Brand#8": "Psocodea"}
OLD_ORDER_NAMES = ORDER_NAMES | {"Brand#5": "Heteroptera", "Brand#6": "Dictyoptera", "Brand#8": "Psocoptera",
                                 "Brand#9": "Auchenorrhyncha", "Brand#10": "Sternorrhyncha"}
# families that a rule names; the larval table spells the first one the old way
FAMILY_NAMES = {"coldgizmo": "Trogossitidae", "hotrod": "Isotomidae", "newring": "Acaridae", "oldbolt": "Heterosminthurus",
                "largeplate": "Ichneumonidae"}
LARVAL_FAMILY_NAMES = FAMILY_NAMES | {"coldgizmo": "Trogositidae"}
SUB_FAMILY_NAMES = ["Mymarommatidae", "Pyrgotidae", "Eucharitidae", "Stephanidae", "Mantispidae", "Cryptochetidae", "Eginiidae",
                    "Leucospidae"]
# Every source uses every row of ``part``.  That a family is in one source and not in the next comes from the key: each
# n-th part has a family of the source's own, (n, ending).
OWN_FAMILIES = {"body": (5, "ella"), "larval": (4, "ina"), "feeding": (3, "oides"), "soil": (6, "aria"), "expert": (7, "ops"),
                "mites": (2, "ides"), "spiders": (3, "neae")}
TYPE_NICHES = {"ECONOMY": "Phytophagous", "LARGE": "Predator", "MEDIUM": "Saprophagous", "PROMO": "General",
               "SMALL": "Phytophate-parasitoid", "STANDARD": "Parasite"}
SUBFAMILY_FAMILIES_TD = ["smallring", "redwidget", "bluebolt"]


def _case_sql(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE {col} END"


def _map(col, mapping: dict[str, str]):
    return ef.recode(col, mapping)


def _fam(source: str | None = None, names: dict[str, str] = FAMILY_NAMES):
    """Family of a part, with the ending of the source's own families (``own`` is a column of ``_parts``)."""
    name = _map(F.replace(F.col("p_name"), F.lit(" "), F.lit("")), names)
    return F.concat(name, F.when(F.col("own"), F.lit(OWN_FAMILIES[source][1])).otherwise(F.lit(""))) if source else name


def _fam_sql(source: str | None = None, names: dict[str, str] = FAMILY_NAMES, col: str = "p_name") -> str:
    name = _case_sql(f"replace({col}, ' ', '')", names)
    return f"{name} || CASE WHEN own THEN '{OWN_FAMILIES[source][1]}' ELSE '' END" if source else name


def _parts(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return td.table(spark, sf_dir, "part").withColumn("own", F.col("p_partkey") % OWN_FAMILIES[source][0] == 0)


def _parts_sql(source: str) -> str:
    return f"(SELECT *, p_partkey % {OWN_FAMILIES[source][0]} = 0 AS own FROM part) p"


def _eu(x):
    """Number -> European text ('12,5'); the value is a multiple of 0.25, so the text is exact."""
    return F.replace(x.cast("string"), F.lit("."), F.lit(","))


# --------------------------------------------------------------------------------------- Spark side
def body_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _parts(spark, sf_dir, "body").groupBy("p_brand", "p_name", "own").agg(F.min("p_size").alias("mn"), F.max("p_size").alias("mx"),
                                           F.count(F.lit(1)).alias("n"), F.min("p_partkey").alias("_ord"))
    txt_min = F.when(F.col("mn") % 7 == 0, F.lit("n/a")).otherwise(_eu(F.col("mn") / 4))
    return g.select(F.concat_ws(" ", _map("p_brand", OLD_ORDER_NAMES), _fam("body")).alias("taxon"),
                    ef.european_double(txt_min).alias("length_min"),
                    ef.european_double(_eu(F.col("mx") / 2)).alias("length_max"),
                    F.concat(F.lit("R"), F.col("n").cast("string")).alias("reference"), "_ord")


def larval_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promoted / cleaned larval sheet: 2 key columns, a note column, 8 score columns as text."""
    p = _parts(spark, sf_dir, "larval")
    k, s = F.col("p_partkey"), F.col("p_size")
    g = p.groupBy("p_brand", "p_name", "own").agg(
        F.min("p_partkey").alias("_ord"),
        (F.min(k % 10) / 10).alias("saprophagous"), (F.max(k % 7) / 7).alias("zoophagous"),
        (F.max(s % 11) / 10).alias("phytophagous"), (F.min(k % 3) / 2).alias("larva_aquatic"),
        (F.max(s % 5) / 4).alias("mycetophagous"), (F.min(k % 9) / 8).alias("coprophagous"),
        (F.max(s % 6) / 5).alias("saproxylic"), (F.min(k % 8) / 7).alias("roots"))
    scores = ["saprophagous", "zoophagous", "phytophagous", "larva_aquatic", "mycetophagous", "coprophagous",
              "saproxylic", "roots"]
    blank = F.when(F.col("_ord") % 5 == 0, F.lit(" \u00a0")).otherwise(F.lit(""))
    return g.select(_map("p_brand", OLD_ORDER_NAMES).alias("higher_taxon"),
                    F.concat(_fam("larval", LARVAL_FAMILY_NAMES), blank).alias("family"), F.lit("note").alias("x3"),
                    *[F.when(F.col("_ord") % 11 == 0, F.lit("?")).otherwise(F.col(c).cast("string")).alias(c)
                      for c in scores], "_ord")


def feeding_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _parts(spark, sf_dir, "feeding").groupBy("p_brand", "p_name", "p_type", "own").agg(F.min("p_partkey").alias("_ord"))
    n = F.col("_ord") % (len(SUB_FAMILY_NAMES) + 1)
    sub = F.when(F.col("p_type") == "PROMO", F.col("p_type")).when(
        F.col("p_type") == "SMALL", F.get(F.array(F.col("p_type"), *map(F.lit, SUB_FAMILY_NAMES)), n.cast("int")))
    dyn = F.concat_ws("-", _fam("feeding"), sub)
    return g.select(_map("p_brand", ORDER_NAMES).alias("order"), dyn.alias("taxon_dyntaxa_2017"),
                    F.when(F.col("_ord") % 4 != 0, _map("p_type", TYPE_NICHES)).alias("main_feeding_niche"),
                    F.when(F.col("p_type") == "LARGE", F.lit("Water"))
                    .when(F.col("p_type") == "MEDIUM", F.lit("Soil")).alias("main_feeding_habitat"), "_ord")


def soil_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _parts(spark, sf_dir, "soil").groupBy("p_brand", "p_name", "own").agg(F.min("p_partkey").alias("k"), F.max("p_size").alias("s"))
    cls = (F.when(F.col("p_name").contains("ring"), F.lit("Collembola"))
           .when(F.col("p_name").contains("gear") | F.col("p_name").contains("bolt"), F.lit("Arachnida"))
           .otherwise(F.lit("Insecta")))
    phylum = F.when(F.col("s") > 42, F.lit("Chordata")).otherwise(F.lit("Arthropoda"))
    fam = F.concat(_fam("soil"), F.when(F.col("k") % 3 == 0, F.lit("_environmental_sample")).otherwise(F.lit("")))
    taxonomy = F.concat_ws(";", F.lit("Animalia"), phylum, cls, _map("p_brand", ORDER_NAMES), fam,
                           F.lit("g"), F.lit("s"))
    flag = lambda m: F.when(F.col("k") % m == 0, F.lit("x"))
    return g.select(taxonomy.alias("consensus_taconomical_identity"), F.lit("a").alias("x6"),
                    F.lit("b").alias("x16"), F.lit("c").alias("all_inclusive"),
                    flag(2).alias("fungi_feeder"), flag(3).alias("plant_feeder"), flag(5).alias("predator"),
                    flag(7).alias("parasitic_on"), flag(4).alias("parasitoid"),
                    flag(11).alias("bacterivore"), flag(13).alias("litter_feeder"), flag(17).alias("root_feeder"),
                    flag(19).alias("algal_feeder"), F.col("k").alias("_ord"))


def expert_general(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _parts(spark, sf_dir, "expert").groupBy("p_brand", "p_name", "own").agg(F.min("p_size").alias("mn"), F.min("p_partkey").alias("k"),
                                           F.count(F.lit(1)).alias("n"))
    return g.select(_map("p_brand", ORDER_NAMES).alias("higher_taxon"), _fam("expert").alias("family"),
                    F.when(F.col("k") % 3 != 0, (F.col("mn") / 4).cast("string")).alias("length_min"),
                    F.lit("99").alias("length_max"),
                    F.when(F.col("k") % 2 == 0, F.lit("Predator")).alias("main_feeding_niche"),
                    F.when(F.col("k") % 5 == 0, F.lit("Soil")).alias("main_feeding_habitat"),
                    F.col("n").alias("n_otu"), F.col("n").alias("n_obs"), F.col("n").alias("reads"),
                    F.lit("TRUE").alias("in_checklist"))


def taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = td.taxa(spark, sf_dir)
    return t.select("cluster", "phylum", "class", _map("order", ORDER_NAMES).alias("order"),
                    F.replace(F.col("family"), F.lit(" "), F.lit("")).alias("family"), "genus")


def checklist_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``taxonomy`` with the families under the names that the rules know."""
    return taxonomy(spark, sf_dir).withColumn("family", _map("family", FAMILY_NAMES))


# ----------------------------------------------------------------------------------------- SQL side
def _score_sql(expr: str, name: str) -> str:
    return f"CASE WHEN min(p_partkey) % 11 = 0 THEN NULL ELSE {expr} END AS {name}"


SOURCES_SQL = f"""
body AS (
  SELECT {_case_sql('p_brand', OLD_ORDER_NAMES)} AS raw_order, {_fam_sql('body')} AS family,
         CASE WHEN min(p_size) % 7 = 0 THEN NULL ELSE min(p_size) / 4 END AS length_min,
         max(p_size) / 2 AS length_max, 'R' || CAST(count(*) AS VARCHAR) AS mass_reference,
         min(p_partkey) AS ord
  FROM {_parts_sql('body')} GROUP BY p_brand, p_name, own),
larval AS (
  SELECT {_case_sql('p_brand', OLD_ORDER_NAMES)} AS higher_taxon,
         {_fam_sql('larval', LARVAL_FAMILY_NAMES)} || CASE WHEN min(p_partkey) % 5 = 0 THEN ' ' || chr(160) ELSE '' END AS family,
         {_score_sql('min(p_partkey % 10) / 10', 'saprophagous')}, {_score_sql('max(p_partkey % 7) / 7', 'zoophagous')},
         {_score_sql('max(p_size % 11) / 10', 'phytophagous')}, {_score_sql('min(p_partkey % 3) / 2', 'larva_aquatic')},
         {_score_sql('max(p_size % 5) / 4', 'mycetophagous')}, {_score_sql('min(p_partkey % 9) / 8', 'coprophagous')},
         {_score_sql('max(p_size % 6) / 5', 'saproxylic')}, {_score_sql('min(p_partkey % 8) / 7', 'roots')},
         min(p_partkey) AS ord
  FROM {_parts_sql('larval')} GROUP BY p_brand, p_name, own),
feeding AS (
  SELECT {_case_sql('p_brand', ORDER_NAMES)} AS raw_order, {_fam_sql('feeding')} AS family,
         CASE p_type WHEN 'PROMO' THEN p_type
                     WHEN 'SMALL' THEN (['SMALL', {", ".join(f"'{v}'" for v in SUB_FAMILY_NAMES)}])[min(p_partkey) % {len(SUB_FAMILY_NAMES) + 1} + 1]
         END AS sub_family,
         CASE WHEN min(p_partkey) % 4 = 0 THEN NULL ELSE {_case_sql('p_type', TYPE_NICHES)} END
           AS main_feeding_niche,
         CASE WHEN p_type = 'LARGE' THEN 'Water' WHEN p_type = 'MEDIUM' THEN 'Soil' END
           AS main_feeding_habitat,
         min(p_partkey) AS ord
  FROM {_parts_sql('feeding')} GROUP BY p_brand, p_name, p_type, own),
soil_g AS (
  SELECT p_brand, p_name, own, min(p_partkey) AS k, max(p_size) AS s,
         CASE WHEN p_name LIKE '%ring%' THEN 'Collembola'
              WHEN p_name LIKE '%gear%' OR p_name LIKE '%bolt%' THEN 'Arachnida' ELSE 'Insecta' END AS cls
  FROM {_parts_sql('soil')} GROUP BY p_brand, p_name, own),
soil_long AS (
  SELECT {_case_sql('p_brand', ORDER_NAMES)} AS higher_taxon, {_fam_sql('soil')} AS family, k AS ord,
         niche_original
  FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'x' END AS fungi_feeder, CASE WHEN k % 3 = 0 THEN 'x' END AS plant_feeder,
               CASE WHEN k % 5 = 0 THEN 'x' END AS predator, CASE WHEN k % 7 = 0 THEN 'x' END AS parasitic_on,
               CASE WHEN k % 4 = 0 THEN 'x' END AS parasitoid, CASE WHEN k % 11 = 0 THEN 'x' END AS bacterivore,
               CASE WHEN k % 13 = 0 THEN 'x' END AS litter_feeder, CASE WHEN k % 17 = 0 THEN 'x' END AS root_feeder,
               CASE WHEN k % 19 = 0 THEN 'x' END AS algal_feeder FROM soil_g
        WHERE s <= 42 AND cls IN ('Arachnida', 'Collembola')) t
  UNPIVOT (value FOR niche_original IN (fungi_feeder, plant_feeder, predator, parasitic_on, parasitoid,
                                             bacterivore, litter_feeder, root_feeder, algal_feeder))),
soil AS (
  SELECT higher_taxon, family,
         CASE WHEN family IN ('Acaridae', 'Heterosminthurus') THEN 'Saprophagous'
              WHEN regexp_matches(niche_original, 'fungi|bacteriv|litter|root|algal') THEN 'Saprophagous'
              WHEN regexp_matches(niche_original, 'plant') THEN 'Phytophagous'
              WHEN regexp_matches(niche_original, 'predator') THEN 'Predator'
              WHEN regexp_matches(niche_original, 'parasitic') THEN 'Parasite' END AS main_feeding_niche,
         ord
  FROM soil_long),
expert AS (
  SELECT {_case_sql('p_brand', ORDER_NAMES)} AS higher_taxon, {_fam_sql('expert')} AS family,
         CASE WHEN min(p_partkey) % 3 = 0 THEN NULL ELSE min(p_size) / 4 END AS length_min,
         99.0 AS length_max,
         CASE WHEN min(p_partkey) % 2 = 0 THEN 'Predator' END AS main_feeding_niche,
         CASE WHEN min(p_partkey) % 5 = 0 THEN 'Soil' END AS main_feeding_habitat
  FROM {_parts_sql('expert')} GROUP BY p_brand, p_name, own),
taxo AS (
  SELECT cluster, phylum, class, {_case_sql('"order"', ORDER_NAMES)} AS "order",
         {_fam_sql(col='family')} AS family, genus FROM taxa)"""
