"""Registered queries for the individual pieces of the composite recipes: expert tables and the patch chain
(C5-C7, J7 x3), life-history / completeness reports (C11, C12), and the occurrence steps (C13, C14, C16-C18)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ecospark.operators import joins
from ecospark.operators.distinct import distinct_counts
from ecospark.plans import occurrences as occ
from ecospark.plans import queries_composite as qc
from ecospark.plans import testdata as td
from ecospark.plans import testdata_attributes as tt
from ecospark.plans import attributes
from ecospark.plans.catalog import register
from ecospark.session import checkpoint_dir
from ecospark.sources import tables

_ORD = tt._case_sql("p_brand", tt.ORDER_NAMES)


# ------------------------------------------------------------------------------- expert tables + patches
def _mites_raw(spark, sf_dir):
    p = tt._parts(spark, sf_dir, "mites")
    s = F.col("p_size")
    tick = lambda c: F.when(c, F.lit("x"))
    return p.select(
        F.concat(F.lit("Acari, "), tt._map("p_brand", tt.ORDER_NAMES)).alias("higher_taxon"),
        tt._fam("mites").alias("family"),
        F.when(s % 4 != 0, (s / 10).cast("string")).alias("length_min"),
        F.when(s % 6 != 0, (s / 5).cast("string")).alias("length_max"),
        tick(s < 10).alias("length_1"), tick(s.between(5, 20)).alias("length_1_5"),
        tick(s.between(15, 30)).alias("length_5_10"), tick(s > 25).alias("length_10"),
        F.when(s % 3 != 0, F.lit("Saprophagous")).alias("main_feeding_niche"),
        F.when(s % 5 == 0, F.lit("Soil")).alias("main_feeding_habitat"),
        F.lit("q").alias("x13"), F.lit("c").alias("comment"), F.col("p_partkey").alias("_ord"))


_MITES_SQL = f"""mraw AS (
  SELECT 'Acari, ' || {_ORD} AS higher_taxon, {tt._fam_sql('mites')} AS family,
         CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size / 10 END AS length_min,
         CASE WHEN p_size % 6 = 0 THEN NULL ELSE p_size / 5 END AS length_max,
         CASE WHEN p_size < 10 THEN 'x' END AS length_1, CASE WHEN p_size BETWEEN 5 AND 20 THEN 'x' END AS length_1_5,
         CASE WHEN p_size BETWEEN 15 AND 30 THEN 'x' END AS length_5_10, CASE WHEN p_size > 25 THEN 'x' END AS length_10,
         CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'Saprophagous' END AS main_feeding_niche,
         CASE WHEN p_size % 5 = 0 THEN 'Soil' END AS main_feeding_habitat, p_partkey AS ord
  FROM {tt._parts_sql('mites')}),
m1 AS (
  SELECT higher_taxon, family, length_min, length_max, length_1, length_1_5, length_5_10, length_10,
         main_feeding_niche, main_feeding_habitat, min(ord) AS ord FROM mraw GROUP BY ALL),
m2 AS (
  SELECT higher_taxon, family, min(length_min) OVER (PARTITION BY higher_taxon, family) AS length_min,
         max(length_max) OVER (PARTITION BY higher_taxon, family) AS length_max,
         length_1, length_1_5, length_5_10, length_10, main_feeding_niche, main_feeding_habitat, ord
  FROM m1),
m3 AS (
  SELECT higher_taxon, family, length_min, length_max, length_1, length_1_5, length_5_10, length_10,
         main_feeding_niche, main_feeding_habitat, min(ord) AS ord FROM m2 GROUP BY ALL),
m4 AS (
  SELECT m3.*, c.pos, c.lo, c.hi FROM m3,
    (VALUES (1, 1.0, NULL), (2, 1.0, 5.0), (3, 5.0, 10.0), (4, 10.0, NULL)) AS c(pos, lo, hi)
  WHERE CASE c.pos WHEN 1 THEN length_1 WHEN 2 THEN length_1_5 WHEN 3 THEN length_5_10 ELSE length_10 END
        IS NOT NULL),
m5 AS (
  SELECT regexp_replace(higher_taxon, '.*,\\s', '') AS higher_taxon, family,
         coalesce(length_min, lo) AS length_min,
         CASE WHEN coalesce(length_min, lo) = 1 AND coalesce(length_max, hi) IS NULL THEN 1.0
              ELSE coalesce(length_max, hi) END AS length_max,
         main_feeding_niche, main_feeding_habitat, ord, pos
  FROM m4),
mites AS (
  SELECT DISTINCT higher_taxon, family, length_min, length_max, main_feeding_niche,
         main_feeding_habitat
  FROM (SELECT *, row_number() OVER (PARTITION BY higher_taxon, family ORDER BY ord, pos) AS rn FROM m5) t
  WHERE rn = 1)"""


@register("expert_mites", f"""WITH {_MITES_SQL}
SELECT * FROM mites""")
def expert_mites(spark: SparkSession, sf_dir: str):
    """Body-length classes to min / max, group extremes, first row per family."""
    return attributes.tidy_expert_mites(_mites_raw(spark, sf_dir))


def _spiders_raw(spark, sf_dir):
    g = tt._parts(spark, sf_dir, "spiders").groupBy("p_brand", "p_name", "own").agg(F.min("p_size").alias("mn"), F.max("p_size").alias("mx"))
    return g.select(tt._map("p_brand", tt.ORDER_NAMES).alias("higher_taxon"), tt._fam("spiders").alias("family"),
                    (F.col("mn") / 2).alias("length_min"), F.when(F.col("mx") % 3 != 0, F.col("mx").cast("double"))
                    .alias("lenght_max"), F.lit("Predator").alias("main_feeding_niche"),
                    F.when(F.col("mn") % 2 == 0, F.lit("Plants")).alias("main_feeding_habitat"),
                    F.lit("n").alias("notes"))


_SPIDERS_SQL = f"""spiders AS (
  SELECT {_ORD} AS higher_taxon, {tt._fam_sql('spiders')} AS family, min(p_size) / 2 AS length_min,
         CASE WHEN max(p_size) % 3 = 0 THEN NULL ELSE CAST(max(p_size) AS DOUBLE) END AS length_max,
         'Predator' AS main_feeding_niche,
         CASE WHEN min(p_size) % 2 = 0 THEN 'Plants' END AS main_feeding_habitat
  FROM {tt._parts_sql('spiders')} GROUP BY p_brand, p_name, own)"""


def _patch_base(spark, sf_dir):
    p = td.table(spark, sf_dir, "part")
    g = p.groupBy("p_brand", "p_name").agg(F.min("p_partkey").alias("k"), F.min("p_size").alias("mn"))
    return g.select(tt._map("p_brand", tt.ORDER_NAMES).alias("higher_taxon"), tt._fam().alias("family"),
                    F.when(F.col("k") % 2 != 0, F.col("mn").cast("double")).alias("length_min"),
                    F.when(F.col("k") % 3 != 0, (F.col("mn") * 2).cast("double")).alias("length_max"),
                    F.when(F.col("k") % 5 != 0, F.lit("Phytophagous")).alias("main_feeding_niche"),
                    F.when(F.col("k") % 7 != 0, F.lit("Water")).alias("main_feeding_habitat"))


_BASE_SQL = f"""base AS (
  SELECT {_ORD} AS higher_taxon, {tt._fam_sql()} AS family,
         CASE WHEN min(p_partkey) % 2 = 0 THEN NULL ELSE CAST(min(p_size) AS DOUBLE) END AS length_min,
         CASE WHEN min(p_partkey) % 3 = 0 THEN NULL ELSE CAST(min(p_size) * 2 AS DOUBLE) END AS length_max,
         CASE WHEN min(p_partkey) % 5 = 0 THEN NULL ELSE 'Phytophagous' END AS main_feeding_niche,
         CASE WHEN min(p_partkey) % 7 = 0 THEN NULL ELSE 'Water' END AS main_feeding_habitat
  FROM part GROUP BY p_brand, p_name),
tr_t AS (
  SELECT higher_taxon, family, length_min, length_max, main_feeding_niche, main_feeding_habitat
  FROM expert WHERE (main_feeding_niche IS NOT NULL OR main_feeding_habitat IS NOT NULL)
    AND family <> 'Ichneumonidae')"""

_PATCH_COLS = ["length_min", "length_max", "main_feeding_niche", "main_feeding_habitat"]


def _patch_sql(x: str, y: str) -> str:
    cols = ", ".join(f"coalesce({x}.{c}, {y}.{c}) AS {c}" for c in _PATCH_COLS)
    return (f"SELECT {x}.higher_taxon, {x}.family, {cols} FROM {x} LEFT JOIN {y} "
            f"ON {x}.higher_taxon IS NOT DISTINCT FROM {y}.higher_taxon AND {x}.family IS NOT DISTINCT FROM {y}.family")


@register("expert_patches", td.with_views(f""", {tt.SOURCES_SQL}, {_MITES_SQL}, {_SPIDERS_SQL}, {_BASE_SQL},
p1 AS ({_patch_sql('base', 'tr_t')}),
p2 AS ({_patch_sql('p1', 'mites')})
{_patch_sql('p2', 'spiders')}""", "taxa"))
def expert_patches(spark: SparkSession, sf_dir: str):
    """Three expert tables patch only the missing cells, in priority order general > mites > spiders."""
    x = _patch_base(spark, sf_dir)
    general = attributes.tidy_expert_general(tt.expert_general(spark, sf_dir)).select(
        "higher_taxon", "family", *_PATCH_COLS)
    mites = attributes.tidy_expert_mites(_mites_raw(spark, sf_dir))
    spiders = attributes.tidy_expert_spiders(_spiders_raw(spark, sf_dir))
    return joins.patch_chain(x, [general, mites, spiders], attributes.KEYS)


# --------------------------------------------------------------------------------- trait-table reports
def _ct_sql(body: str) -> str:
    return "WITH ct AS (\n" + qc.trait_sql(attributes.CURRENT, True, True) + ")\n" + body


@register("missing_life_history", _ct_sql("SELECT higher_taxon, family, larva_aquatic, in_checklist FROM ct WHERE in_checklist"))
def missing_life_history(spark: SparkSession, sf_dir: str):
    """C11: life-history columns (regex selected) of sequenced families."""
    return attributes.missing_life_history(qc.compiled_attributes(spark, sf_dir))


_PATTERN_COLS = ["main_feeding_niche", "length_min", "length_max", *qc.SCORES,
                 "main_feeding_habitat", "class"]


@register("trait_missing_patterns", _ct_sql(
    "SELECT " + ", ".join(f"{c} IS NULL AS {c}" for c in _PATTERN_COLS) + ", count(*) AS n FROM ct GROUP BY ALL"))
def trait_missing_patterns(spark: SparkSession, sf_dir: str):
    """Missingness patterns of the trait columns of the compiled table."""
    return attributes.trait_missing_patterns(qc.compiled_attributes(spark, sf_dir))


@register("complete_case_families", _ct_sql(
    "SELECT family FROM ct WHERE " + " AND ".join(
        f"{c} IS NOT NULL" for c in ["higher_taxon", "family", "mass_reference", "in_checklist", *_PATTERN_COLS])))
def complete_case_families(spark: SparkSession, sf_dir: str):
    """Families whose columns, the sub-family aside, are all there."""
    return attributes.complete_case_families(qc.compiled_attributes(spark, sf_dir))


# --------------------------------------------------------------------------------- occurrence steps
_SAMPLES = list(range(16))  # every remainder there is: no row falls outside


_TAXO_SQL = f"""taxo AS (
  SELECT cluster, phylum, class, {tt._case_sql('"order"', tt.ORDER_NAMES)} AS "order",
         replace(family, ' ', '') AS family, genus FROM taxa)"""


@register("read_counts_long", td.with_views(f""", {_TAXO_SQL}
SELECT t.cluster, t.phylum, t.class, t."order", t.family, t.genus,
       'P' || CAST(l_orderkey % 16 AS VARCHAR) AS sample_id_ngi, CAST(sum(l_quantity) AS BIGINT) AS read_count
FROM lineitem JOIN taxo t ON t.cluster = l_partkey
WHERE t.phylum = 'Arthropoda'
GROUP BY ALL HAVING sum(l_quantity) > 0""", "taxa"))
def read_counts_long(spark: SparkSession, sf_dir: str):
    """Wide count matrix (one column per sample, headers lower-cased by cleaning) to long,
    zero cells dropped in the explode, inner join to the phylum-filtered taxonomy, sample ids restored."""
    li = td.table(spark, sf_dir, "lineitem").withColumn("sample", F.pmod("l_orderkey", F.lit(16)))
    wide = (li.groupBy(F.col("l_partkey").alias("cluster"))
            .pivot("sample", _SAMPLES).agg(F.sum("l_quantity").cast("bigint")))
    wide = wide.toDF("cluster", *[f"P{i}" for i in _SAMPLES])
    from ecospark.operators.columns import clean_columns
    wide = clean_columns(wide)                                     # P1 -> p1, as the header cleaning does
    return occ.read_counts_long(tt.taxonomy(spark, sf_dir), wide)


_META_SQL = """,
seq AS (
  SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS sample_id_ngi,
         CASE WHEN s_acctbal < 0 THEN 'control' ELSE 'sample' END AS lab_sample_type, s_suppkey AS malaise_id
  FROM supplier),
mal AS (SELECT event_id AS malaise_id, user_id AS trap_id, strftime(ts, '%d/%m/%Y') AS collecting_date,
               1 AS plate_no, ts FROM events),
trp AS (SELECT c_custkey AS trap_id, c_acctbal AS latitude, CAST(c_nationkey AS DOUBLE) AS longitude FROM customer),
meta1 AS (
  SELECT coalesce(s.malaise_id, m.malaise_id) AS malaise_id, s.sample_id_ngi, s.lab_sample_type, m.trap_id,
         m.collecting_date, m.plate_no, m.ts
  FROM seq s FULL JOIN mal m ON s.malaise_id IS NOT DISTINCT FROM m.malaise_id)
SELECT m.sample_id_ngi, m.lab_sample_type, coalesce(m.trap_id, t.trap_id) AS trap_id, m.collecting_date,
       m.plate_no, t.latitude, t.longitude, CAST((dayofyear(m.ts) - 1) // 7 + 1 AS INTEGER) AS week_year
FROM meta1 m FULL JOIN trp t ON m.trap_id IS NOT DISTINCT FROM t.trap_id"""


@register("sample_meta", _META_SQL.replace(",\nseq AS", "WITH seq AS", 1))
def sample_meta(spark: SparkSession, sf_dir: str):
    """Natural full joins of three metadata tables, regex column pick (over-selects
    'plate', D8), date parse, lubridate week."""
    s = td.table(spark, sf_dir, "supplier")
    seq = s.select(F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("sample_id_ngi"),
                   F.when(F.col("s_acctbal") < 0, F.lit("control")).otherwise(F.lit("sample")).alias("lab_sample_type"),
                   F.col("s_suppkey").alias("malaise_id"))
    mal = td.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("malaise_id"), F.col("user_id").alias("trap_id"),
        F.date_format("ts", "dd/MM/yyyy").alias("collecting_date"), F.lit(1).alias("plate_no"))
    trp = td.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("trap_id"), F.col("c_acctbal").alias("latitude"),
        F.col("c_nationkey").cast("double").alias("longitude"))
    return occ.sample_meta(seq, mal, trp)


@register("feeding_lookup", td.with_views(f"""
SELECT DISTINCT replace(family, ' ', '') AS family, sub_family AS subfamily,
       {qc._recode_sql('niche', tt.TYPE_NICHES)} AS feeding_niche
FROM tm WHERE family IS NOT NULL""", "tm"))
def feeding_lookup(spark: SparkSession, sf_dir: str):
    """Trait table -> (family, subfamily, feeding_niche), family present, distinct."""
    return qc._feeding(spark, sf_dir)


_SUBFAM_IN = ", ".join(f"'{f}'" for f in tt.SUBFAMILY_FAMILIES_TD)


@register("subfamily_lookup", td.with_views(f"""
SELECT DISTINCT replace(family, ' ', '') AS family, split_part(genus, '_', 1) AS subfamily, genus FROM taxa
WHERE replace(family, ' ', '') IN ({_SUBFAM_IN}) AND genus IS NOT NULL""", "taxa"))
def subfamily_lookup(spark: SparkSession, sf_dir: str):
    """Long classification per taxon -> rank filter -> drop id -> distinct -> pivot -> bind."""
    return occ.subfamily_lookup(qc._classification(tt.taxonomy(spark, sf_dir))).distinct()


@register("classification_files", td.with_views(f"""
SELECT DISTINCT replace(family, ' ', '') AS family, split_part(genus, '_', 1) AS subfamily, genus, false AS lost FROM taxa
WHERE replace(family, ' ', '') IN ({_SUBFAM_IN}) AND genus IS NOT NULL
UNION ALL SELECT NULL, NULL, NULL, true FROM region""", "taxa"))
def classification_files(spark: SparkSession, sf_dir: str):
    """A folder of saved classification tables, a few of them broken: the others are read and bound, and a
    row stands for each file that is lost."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/classification-{uuid.uuid4().hex}"
    qc._classification(tt.taxonomy(spark, sf_dir)).repartition(8, "taxon_key").write.parquet(f"{path}/sound")
    broken = td.table(spark, sf_dir, "region").select("r_regionkey", F.concat(F.lit("PAR1"), "r_name").alias("value"))
    broken.write.partitionBy("r_regionkey").text(f"{path}/broken")  # a file a region that begins like a table and ends there
    found = tables.read_table_list(spark, path, "taxon_key string, rank string, name string, id long")
    good = occ.subfamily_lookup(found.where("error IS NULL").drop("file", "error")).distinct()
    lost = found.where("error IS NOT NULL").select(*[F.lit(None).cast("string").alias(c) for c in good.columns])
    return good.withColumn("lost", F.lit(False)).unionByName(lost.withColumn("lost", F.lit(True)))


@register("occurrence_attributes", qc.NICHE_SQL[:qc.NICHE_SQL.index("\ng AS (") + 1] + """d AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT class, feeding_niche, count(*) AS n_rows, count(DISTINCT {'x': cluster}) AS n_clusters FROM d GROUP BY ALL""")
def occurrence_attributes(spark: SparkSession, sf_dir: str):
    """Occurrences with attributes - three families by (family, subfamily), the rest by
    family with fan-out (D14); summarised per (class, niche) so the whole table is compared."""
    taxo, o = qc._occurrence_inputs(spark, sf_dir)
    subs = occ.subfamily_lookup(qc._classification(taxo))
    all_data = occ.occurrence_attributes(o, subs, qc._feeding(spark, sf_dir), tt.SUBFAMILY_FAMILIES_TD)
    # a task combines its rows by bit words of clusters; a table of single clusters grew to a GB a task
    found = distinct_counts(all_data.withColumn("__one", F.lit(1)), ["class", "feeding_niche"], {"n_clusters": "cluster"},
                            {"n_rows": "__one"})
    return found.select("class", "feeding_niche", "n_rows", "n_clusters")

