"""Registered composite queries: the user-visible deliverables (C1-C24) on test-data analogues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ecospark import functions as ef
from ecospark.operators import joins
from ecospark.plans import occurrences as occ
from ecospark.plans import oracle_rules as orules
from ecospark.plans import summaries, attributes
from ecospark.plans import testdata as td
from ecospark.plans import testdata_attributes as tt
from ecospark.plans import trait_rules as tr
from ecospark.plans.catalog import register

WS = "' ' || chr(160)"
SCORES = ["saprophagous", "zoophagous", "phytophagous", "larva_aquatic", "mycetophagous", "coprophagous",
          "saproxylic", "roots"]


def _recode_sql(col: str, mapping: dict[str, str]) -> str:
    if not mapping:
        return col
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {whens} ELSE {col} END"


def _ns(a: str, b: str, keys) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys)


def trait_sql(recipe: attributes.TraitRecipe, with_soil: bool, with_expert: bool) -> str:
    """Oracle SQL for the trait compilation analogue (current recipe or the older one)."""
    trim = recipe.trim_before_join

    older = recipe is attributes.V1

    def t(col):
        return f"rtrim({col}, {WS})" if trim else col

    ords = ["ord_body", "ord_larval", "ord_feeding"] + (["ord_soil"] if with_soil else [])
    body_cols = "higher_taxon, family, length_min, length_max, mass_reference"
    body_ht = orules.ORDER_SYNONYMS.format("raw_order") if recipe.body_recode else "raw_order"
    body_sel = f"SELECT {body_ht} AS higher_taxon, family, length_min, length_max, mass_reference, ord FROM body"
    body_t = (f"SELECT {body_cols}, min(ord) AS ord FROM ({body_sel}) b GROUP BY ALL"
              if recipe.body_distinct else body_sel)
    larval_t = (f"SELECT {(orules.ORDER_SYNONYMS_OLDER if older else orules.ORDER_SYNONYMS).format(t('higher_taxon'))} AS higher_taxon, "
                f"{orules.FAMILY_SYNONYMS.format(t('family'))} AS family, {', '.join(SCORES)}, min(ord) AS ord "
                f"FROM larval GROUP BY ALL")
    feed_sel = (f"SELECT {(orules.FEEDING_SYNONYMS_OLDER if older else orules.ORDER_SYNONYMS).format(t('raw_order'))} AS higher_taxon, {t('family')} AS family, "
                f"sub_family, main_feeding_niche, main_feeding_habitat, ord FROM feeding")
    feeding_t = (f"SELECT higher_taxon, family, sub_family, main_feeding_niche, "
                 f"main_feeding_habitat, min(ord) AS ord FROM ({feed_sel}) f GROUP BY ALL"
                 if recipe.feeding_distinct else feed_sel)
    k2 = ["higher_taxon", "family"]
    j1 = (f"SELECT coalesce(b.higher_taxon, l.higher_taxon) AS higher_taxon, coalesce(b.family, l.family) AS family, "
          f"b.length_min, b.length_max, b.mass_reference, {', '.join('l.' + s for s in SCORES)}, "
          f"b.ord AS ord_body, l.ord AS ord_larval FROM body_t b FULL JOIN larval_t l ON {_ns('b', 'l', k2)}")
    j1_rest = f"length_min, length_max, mass_reference, {', '.join(SCORES)}, ord_body, ord_larval"
    j2 = (f"SELECT coalesce(a.higher_taxon, f.higher_taxon) AS higher_taxon, coalesce(a.family, f.family) AS family, "
          f"{', '.join('a.' + c.strip() for c in j1_rest.split(','))}, f.sub_family, f.main_feeding_niche, "
          f"f.main_feeding_habitat, f.ord AS ord_feeding FROM j1 a FULL JOIN feeding_t f ON {_ns('a', 'f', k2)}")
    rest2 = [c.strip() for c in j1_rest.split(",")] + ["sub_family", "main_feeding_habitat", "ord_feeding"]
    if with_soil:
        k3 = k2 + ["main_feeding_niche"]
        j3 = (f"SELECT {', '.join(f'coalesce(a.{k}, s.{k}) AS {k}' for k in k3)}, "
              f"{', '.join('a.' + c for c in rest2)}, s.ord AS ord_soil FROM j2 a FULL JOIN soil s ON {_ns('a', 's', k3)}")
        merged = "j3"
    else:
        j3 = None
        merged = "j2"
    all_cols = ["higher_taxon", "family", "main_feeding_niche"] + rest2 + (["ord_soil"] if with_soil else [])
    keys_trim = "" if trim else (f"SELECT * REPLACE (rtrim(higher_taxon, {WS}) AS higher_taxon, "
                                 f"rtrim(family, {WS}) AS family) FROM {merged}")
    src = "trimmed" if not trim else merged
    rules = (f"SELECT * REPLACE ({orules.NICHE_FILL} "
             f"AS main_feeding_niche, {orules.HABITAT_FILL} "
             f"AS main_feeding_habitat) FROM {src}")
    over = (f"SELECT * REPLACE ({orules.NICHE_OVERRIDES_OLDER if older else orules.NICHE_OVERRIDES} "
            f"AS main_feeding_niche) FROM r1")
    ht_over = (f"SELECT * REPLACE ({orules.ORDER_OVERRIDES} AS higher_taxon) "
               f"FROM r2" if not older else "SELECT * FROM r2")
    orders_in = orules.BACKFILL_ORDERS
    order_by = ", ".join(f"{o} ASC NULLS LAST" for o in ords)

    def fill(c):
        down = f"last_value({c} IGNORE NULLS) OVER (PARTITION BY higher_taxon ORDER BY {order_by} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        up = f"first_value({c} IGNORE NULLS) OVER (PARTITION BY higher_taxon ORDER BY {order_by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        return f"coalesce({c}, {down}, {up}) AS {c}"

    bf = (f"SELECT * REPLACE ({fill('length_min')}, {fill('length_max')}) FROM r3 WHERE higher_taxon IN ({orders_in}) "
          f"UNION ALL SELECT * FROM r3 WHERE higher_taxon IS NULL OR higher_taxon NOT IN ({orders_in})")
    phy = "WHERE phylum = 'Arthropoda'" if recipe.phylum_filter else ""
    fam_cols = ("class, " if recipe.with_class else "") + '"order" AS higher_taxon, family'
    fams = f"SELECT DISTINCT {fam_cols} FROM taxo {phy}"
    bf_rest = [c for c in all_cols if c not in k2]
    nat = (f"SELECT coalesce(x.higher_taxon, y.higher_taxon) AS higher_taxon, coalesce(x.family, y.family) AS family, "
           f"{', '.join('x.' + c for c in bf_rest)}{', y.class' if recipe.with_class else ''} "
           f"FROM bf x FULL JOIN fams y ON {_ns('x', 'y', k2)}")
    mem_filter = "AND t.phylum = 'Arthropoda'" if recipe.phylum_filter else ""
    marked = (f"SELECT n.*, EXISTS (SELECT 1 FROM taxo t WHERE t.family IS NOT DISTINCT FROM n.family {mem_filter}) "
              f"AS in_checklist FROM nat n")
    out_cols = [c for c in ["higher_taxon", "family"] + bf_rest + (["class"] if recipe.with_class else []) + ["in_checklist"]
                if not c.startswith("ord_")]
    patch_cols = ["length_min", "length_max", "main_feeding_niche", "main_feeding_habitat"]
    if with_expert:
        expert_t = ("SELECT * FROM expert WHERE (main_feeding_niche IS NOT NULL OR "
                    "main_feeding_habitat IS NOT NULL) AND family <> 'Ichneumonidae'")
        final = (f"SELECT {', '.join(f'coalesce(m.{c}, e.{c}) AS {c}' if c in patch_cols else 'm.' + c for c in out_cols)} "
                 f"FROM marked m LEFT JOIN expert_t e ON {_ns('m', 'e', k2)}")
    else:
        expert_t = None
        final = f"SELECT {', '.join(out_cols)} FROM marked"
    ctes = [("body_t", body_t), ("larval_t", larval_t), ("feeding_t", feeding_t), ("j1", j1), ("j2", j2)]
    if j3:
        ctes.append(("j3", j3))
    if keys_trim:
        ctes.append(("trimmed", keys_trim))
    ctes += [("r1", rules), ("r2", over), ("r3", ht_over), ("bf", bf), ("fams", fams), ("nat", nat),
             ("marked", marked)]
    if expert_t:
        ctes.append(("expert_t", expert_t))
    body = ",\n".join(f"{n} AS ({q})" for n, q in ctes)
    return td.with_views(f", {tt.SOURCES_SQL},\n{body}\n{final}", "taxa")


def _trait_inputs(spark, sf_dir, recipe):
    body = attributes.tidy_body_size(tt.body_raw(spark, sf_dir), recipe)
    larval = attributes.tidy_larval_niche(tt.larval_sheet(spark, sf_dir), recipe, score_positions=(4, 11))
    feeding = attributes.tidy_feeding_niche(tt.feeding_raw(spark, sf_dir), recipe)
    return body, larval, feeding


@register("trait_compile", trait_sql(attributes.CURRENT, with_soil=True, with_expert=True))
def trait_compile(spark: SparkSession, sf_dir: str):
    """Body size, larval niche, feeding niche and soil sources tidied, merged by three null-safe full
    joins, rule-filled, back-filled, joined to the sequenced-family checklist, flagged, expert-patched."""
    body, larval, feeding = _trait_inputs(spark, sf_dir, attributes.CURRENT)
    soil = attributes.tidy_soil_niche(tt.soil_raw(spark, sf_dir))
    expert = attributes.tidy_expert_general(tt.expert_general(spark, sf_dir))
    return attributes.compile_attributes(body, larval, feeding, soil, tt.checklist_taxonomy(spark, sf_dir), [expert])


@register("all_attributes_v1", trait_sql(attributes.V1, with_soil=False, with_expert=False))
def all_attributes_v1(spark: SparkSession, sf_dir: str):
    """The older recipe as a configuration: trim after the joins, no recode / distinct of body sizes,
    opposite Blattodea mapping, no soil or expert data, no phylum filter, no class column."""
    body, larval, feeding = _trait_inputs(spark, sf_dir, attributes.V1)
    return attributes.compile_attributes(body, larval, feeding, None, tt.checklist_taxonomy(spark, sf_dir), [], attributes.V1)


# ------------------------------------------------------------------------------------ trait reports
def compiled_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The compiled table that the reports are made of, compiled from the given tables on every call."""
    return trait_compile(spark, sf_dir)


@register("trait_completeness", "WITH ct AS (\n" + trait_sql(attributes.CURRENT, True, True) + """)
SELECT higher_taxon, family, length_min, length_max, main_feeding_niche, main_feeding_habitat,
       in_checklist
FROM ct WHERE higher_taxon IS NOT NULL AND family IS NOT NULL AND length_min IS NOT NULL AND length_max IS NOT NULL
  AND main_feeding_niche IS NOT NULL AND main_feeding_habitat IS NOT NULL AND in_checklist IS NOT NULL
  AND mass_reference IS NOT NULL AND class IS NOT NULL
  AND saprophagous IS NOT NULL AND zoophagous IS NOT NULL AND phytophagous IS NOT NULL AND larva_aquatic IS NOT NULL
  AND mycetophagous IS NOT NULL AND coprophagous IS NOT NULL AND saproxylic IS NOT NULL AND roots IS NOT NULL""")
def trait_completeness(spark: SparkSession, sf_dir: str):
    """Complete cases of the compiled table except ``sub_family`` (``drop_na(-sub_family)``)."""
    ct = attributes.complete_attributes(compiled_attributes(spark, sf_dir))
    return ct.select("higher_taxon", "family", "length_min", "length_max", "main_feeding_niche",
                     "main_feeding_habitat", "in_checklist")


# --------------------------------------------------------------------------------- niche richness
NICHE_SQL = td.with_views(f""",
counts AS (SELECT cluster, 'p' || CAST(sample AS VARCHAR) AS sample_id_ngi, reads AS read_count FROM cl),
taxo AS (SELECT cluster, phylum, class, "order", replace(family, ' ', '') AS family, genus FROM taxa),
tl AS (
  SELECT t.cluster, t.class, t.family, t.genus, regexp_replace(c.sample_id_ngi, 'p', 'P') AS sample_id_ngi
  FROM taxo t JOIN counts c ON t.cluster = c.cluster WHERE c.read_count > 0 AND t.phylum = 'Arthropoda'),
seq AS (
  SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS sample_id_ngi,
         CASE WHEN s_acctbal < 0 THEN 'control' ELSE 'sample' END AS lab_sample_type, s_suppkey AS malaise_id
  FROM supplier),
mal AS (SELECT event_id AS malaise_id, user_id AS trap_id, ts FROM events),
trp AS (SELECT c_custkey AS trap_id FROM customer),
meta1 AS (
  SELECT s.sample_id_ngi, s.lab_sample_type, m.trap_id, m.ts
  FROM seq s FULL JOIN mal m ON s.malaise_id IS NOT DISTINCT FROM m.malaise_id),
meta AS (
  SELECT m.sample_id_ngi, m.lab_sample_type, coalesce(m.trap_id, t.trap_id) AS trap_id,
         CAST((dayofyear(m.ts) - 1) // 7 + 1 AS INTEGER) AS week_year
  FROM meta1 m FULL JOIN trp t ON m.trap_id IS NOT DISTINCT FROM t.trap_id),
occ AS (
  SELECT tl.cluster, tl.class, tl.family, tl.genus, meta.lab_sample_type, meta.trap_id, meta.week_year
  FROM tl FULL JOIN meta ON tl.sample_id_ngi IS NOT DISTINCT FROM meta.sample_id_ngi),
feeding AS (
  SELECT DISTINCT replace(family, ' ', '') AS family, sub_family AS subfamily,
         {_recode_sql('niche', tt.TYPE_NICHES)} AS feeding_niche
  FROM tm WHERE family IS NOT NULL),
subf AS (
  SELECT DISTINCT family, split_part(genus, '_', 1) AS subfamily, genus FROM taxo
  WHERE family IN ({', '.join(f"'{f}'" for f in tt.SUBFAMILY_FAMILIES_TD)}) AND genus IS NOT NULL),
a AS (
  SELECT o.cluster, o.class, o.lab_sample_type, o.trap_id, o.week_year, f.feeding_niche
  FROM (SELECT occ.*, subf.subfamily FROM occ LEFT JOIN subf ON {_ns('occ', 'subf', ['family', 'genus'])}
        WHERE occ.family IN ({', '.join(f"'{f}'" for f in tt.SUBFAMILY_FAMILIES_TD)})) o
  LEFT JOIN feeding f ON {_ns('o', 'f', ['family', 'subfamily'])}),
b AS (
  SELECT occ.cluster, occ.class, occ.lab_sample_type, occ.trap_id, occ.week_year, f.feeding_niche
  FROM occ LEFT JOIN feeding f ON occ.family IS NOT DISTINCT FROM f.family
  WHERE occ.family IS NULL OR occ.family NOT IN ({', '.join(f"'{f}'" for f in tt.SUBFAMILY_FAMILIES_TD)})),
g AS (
  SELECT feeding_niche, week_year, trap_id, count(DISTINCT {{'x': cluster}}) AS n_OTU
  FROM (SELECT * FROM a UNION ALL SELECT * FROM b) d
  WHERE class = 'Insecta' AND lab_sample_type = 'sample' GROUP BY ALL)
SELECT CASE WHEN feeding_niche IN ({orules.NICHE_LEVELS}) THEN feeding_niche END
         AS feeding_niche, week_year, trap_id, n_OTU
FROM g WHERE feeding_niche IS NOT NULL AND NOT regexp_matches(feeding_niche, 'General|Parasite')""",
                          "cl", "taxa", "tm")


def _occurrence_inputs(spark, sf_dir):
    taxo = tt.taxonomy(spark, sf_dir)
    counts = td.cl(spark, sf_dir).select(
        "cluster", F.concat(F.lit("p"), F.col("sample").cast("string")).alias("sample_id_ngi"),
        F.col("reads").alias("read_count"))
    long = occ.read_counts_long(taxo, counts, wide=False)
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
    meta = occ.sample_meta(seq, mal, trp)
    return taxo, occ.occurrences(long, meta)


def _feeding(spark, sf_dir):
    t = td.tm(spark, sf_dir)
    all_attributes = t.select(F.replace(F.col("family"), F.lit(" "), F.lit("")).alias("family"), "sub_family",
                          ef.recode("niche", tt.TYPE_NICHES).alias("main_feeding_niche"))
    return occ.feeding_lookup(all_attributes)


def _classification(taxo):
    """Long classification (taxon_key, name, rank, id) for the genera of the sub-family families."""
    t = taxo.filter(ef.is_in("family", tt.SUBFAMILY_FAMILIES_TD) & F.col("genus").isNotNull()) \
        .select("family", "genus", "order").distinct()
    t = t.select(F.concat_ws("|", "family", "genus").alias("taxon_key"), "family",
                 F.split_part("genus", F.lit("_"), F.lit(1)).alias("subfamily"), "genus", "order")
    long = t.unpivot(["taxon_key"], ["order", "family", "subfamily", "genus"], "rank", "name")
    return long.withColumn("id", F.xxhash64("taxon_key", "rank"))


@register("niche_richness", NICHE_SQL)
def niche_richness(spark: SparkSession, sf_dir: str):
    """Long counts x taxonomy x sample metadata, sub-family lookup for three families, trait join,
    then distinct clusters per (feeding niche, week, trap) for insect samples."""
    taxo, o = _occurrence_inputs(spark, sf_dir)
    subs = occ.subfamily_lookup(_classification(taxo))
    all_data = occ.occurrence_attributes(o, subs, _feeding(spark, sf_dir), tt.SUBFAMILY_FAMILIES_TD)
    return occ.niche_richness(all_data)


def _between(text: str, first: str, last: str) -> str:
    return text[text.index(first):text.index(last)]


OCCURRENCE_ROWS_SQL = _between(NICHE_SQL, NICHE_SQL[0], "occ AS (") + """occ AS (
  SELECT tl.cluster, tl.class, tl.family, tl.genus, coalesce(tl.sample_id_ngi, meta.sample_id_ngi) AS sample_id_ngi,
         meta.lab_sample_type, meta.trap_id, meta.week_year
  FROM tl FULL JOIN meta ON tl.sample_id_ngi IS NOT DISTINCT FROM meta.sample_id_ngi),
""" + _between(NICHE_SQL, "feeding AS (", "\na AS (") + f"""
a AS (
  SELECT o.*, f.feeding_niche
  FROM (SELECT occ.*, subf.subfamily FROM occ LEFT JOIN subf ON {_ns('occ', 'subf', ['family', 'genus'])}
        WHERE occ.family IN ({', '.join(f"'{f}'" for f in tt.SUBFAMILY_FAMILIES_TD)})) o
  LEFT JOIN feeding f ON {_ns('o', 'f', ['family', 'subfamily'])}),
b AS (
  SELECT occ.*, f.subfamily, f.feeding_niche FROM occ LEFT JOIN feeding f ON occ.family IS NOT DISTINCT FROM f.family
  WHERE occ.family IS NULL OR occ.family NOT IN ({', '.join(f"'{f}'" for f in tt.SUBFAMILY_FAMILIES_TD)}))
SELECT * FROM a UNION ALL SELECT * FROM b"""


@register("occurrence_rows", OCCURRENCE_ROWS_SQL)
def occurrence_rows(spark: SparkSession, sf_dir: str):
    """Every row of the occurrence table with its sample, week, trap, sub-family and niche."""
    taxo, o = _occurrence_inputs(spark, sf_dir)
    subs = occ.subfamily_lookup(_classification(taxo))
    rows = occ.occurrence_attributes(o, subs, _feeding(spark, sf_dir), tt.SUBFAMILY_FAMILIES_TD)
    return rows.select("cluster", "class", "family", "genus", "sample_id_ngi", "lab_sample_type", "trap_id", "week_year",
                       "subfamily", "feeding_niche")


# ----------------------------------------------------------------------------- missing-trait reports
_ALL_ATTRIBUTES_TD_SQL = """atr AS (
  SELECT tm.higher_taxon, tm.family, tm.length_min, tm.length_max, tm.niche AS main_feeding_niche,
         CASE WHEN tm.ord % 3 = 0 THEN NULL ELSE 'Plants' END AS main_feeding_habitat,
         EXISTS (SELECT 1 FROM taxa WHERE taxa.family IS NOT DISTINCT FROM tm.family AND taxa.phylum = 'Arthropoda')
           AS in_checklist
  FROM tm),
mt AS (
  SELECT * FROM atr WHERE length_min IS NULL OR length_max IS NULL OR main_feeding_niche IS NULL
                      OR main_feeding_habitat IS NULL)"""


def _all_attributes_td(spark, sf_dir):
    t = td.tm(spark, sf_dir)
    at = t.select("higher_taxon", "family", "length_min", "length_max",
                  F.col("niche").alias("main_feeding_niche"),
                  F.when(F.col("ord") % 3 != 0, F.lit("Plants")).alias("main_feeding_habitat"))
    taxa = td.taxa(spark, sf_dir).filter(F.col("phylum") == tr.ARTHROPOD_PHYLUM)
    return joins.mark_join(at, taxa, ["family"], "in_checklist")


_FR_SQL = """fr AS (
  SELECT family, count(DISTINCT {'x': cluster}) AS n_otu, count(DISTINCT {'x': trap}) AS n_obs,
         CAST(sum(reads) AS BIGINT) AS reads
  FROM (SELECT cl.cluster, cl.reads, taxa.family, traps.trap
        FROM cl LEFT JOIN traps ON cl.sample IS NOT DISTINCT FROM traps.sample
                LEFT JOIN taxa ON cl.cluster IS NOT DISTINCT FROM taxa.cluster
        WHERE cl.reads > 0) o
  GROUP BY family)"""


@register("missing_attributes_report", td.with_views(f""", {_ALL_ATTRIBUTES_TD_SQL}, {_FR_SQL}
SELECT mt.*, fr.n_otu, fr.n_obs, fr.reads
FROM mt LEFT JOIN fr ON mt.family IS NOT DISTINCT FROM fr.family WHERE mt.in_checklist""", "tm", "taxa", "cl", "traps"))
def missing_attributes_report(spark: SparkSession, sf_dir: str):
    """Families with a missing trait, joined to reads / clusters / traps per family, sequenced only;
    family totals repeat over duplicate (order, family) rows (D13)."""
    missing = summaries.missing_attributes(_all_attributes_td(spark, sf_dir), flag="in_checklist")
    reads = summaries.family_reads(td.cl(spark, sf_dir), td.taxa(spark, sf_dir), td.traps(spark, sf_dir),
                                   sort=False)
    return summaries.missing_attributes_seq(missing, reads, flag="in_checklist")


_NMISS = ("CAST((higher_taxon IS NULL) AS INTEGER) + CAST((family IS NULL) AS INTEGER) "
          "+ CAST((length_min IS NULL) AS INTEGER) + CAST((length_max IS NULL) AS INTEGER) "
          "+ CAST((main_feeding_niche IS NULL) AS INTEGER) "
          "+ CAST((main_feeding_habitat IS NULL) AS INTEGER) + CAST((in_checklist IS NULL) AS INTEGER)")


@register("missing_summary_by_family", td.with_views(f""", {_ALL_ATTRIBUTES_TD_SQL}
SELECT higher_taxon, family, {_NMISS} AS n_missing FROM atr""", "tm", "taxa"))
def missing_summary_by_family(spark: SparkSession, sf_dir: str):
    """C22 as shipped: every family row with its count of missing cells (keys and flag included, D12)."""
    return summaries.missing_summary_by_family(_all_attributes_td(spark, sf_dir))


@register("missing_summary_by_order", td.with_views(f""", {_ALL_ATTRIBUTES_TD_SQL}
SELECT higher_taxon, count(*) AS n_missing_families, CAST(sum(n) AS BIGINT) AS total_missing_attributes
FROM (SELECT higher_taxon, {_NMISS} AS n FROM mt) x WHERE n > 0
GROUP BY higher_taxon ORDER BY n_missing_families DESC, higher_taxon""", "tm", "taxa"))
def missing_summary_by_order(spark: SparkSession, sf_dir: str):
    """C22 as coded: per order, families with missing attributes and their total missing cells, largest first."""
    missing = summaries.missing_attributes(_all_attributes_td(spark, sf_dir), flag="in_checklist")
    return summaries.missing_summary_by_order(missing)


@register("family_checklist", td.with_views("""
SELECT family, count(*) AS n_clusters FROM taxa WHERE family IS NOT NULL GROUP BY family ORDER BY family""",
                                            "taxa"))
def family_checklist(spark: SparkSession, sf_dir: str):
    """Clusters per family from the cluster taxonomy, NA excluded, ascending."""
    return summaries.family_checklist(td.taxa(spark, sf_dir))
