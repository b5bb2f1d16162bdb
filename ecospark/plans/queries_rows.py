"""Registered queries for filters, order-dependent operators, reshaping and aggregations."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ecospark.functions import is_in, not_in
from ecospark.operators import aggregates, columns, filters, reshape, setops, windows
from ecospark.plans import testdata as td
from ecospark.plans.catalog import register

# The order groups that get their body sizes back-filled in the test-data analogue
# (the real recipe uses Protura, Raphidioptera, Siphonaptera, Strepsiptera).
FILL_GROUPS = ["Brand#1", "Brand#7", "Brand#13", "Brand#22"]
_FILL_IN = ", ".join(f"'{g}'" for g in FILL_GROUPS)


def _fill_sql(col: str, part: str = "higher_taxon", order: str = "ord", direction: str = "downup") -> str:
    down = (f"last_value({col} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    up = (f"first_value({col} IGNORE NULLS) OVER (PARTITION BY {part} ORDER BY {order} "
          f"ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")
    return {"down": down, "up": up, "downup": f"coalesce({down}, {up})"}[direction]


# ------------------------------------------------------------------------------------------------ fills
@register("fill_downup", td.with_views(f"""
SELECT ord, higher_taxon, family, {_fill_sql('length_min')} AS length_min, {_fill_sql('length_max')} AS length_max
FROM tm""", "tm"))
def fill_downup(spark: SparkSession, sf_dir: str):
    """Grouped fill, down then up, in ``ord`` order (distributed chunked scan)."""
    t = td.tm(spark, sf_dir).select("ord", "higher_taxon", "family", "length_min", "length_max")
    return windows.fill(t, ["length_min", "length_max"], ["higher_taxon"], ["ord"], "downup")


@register("fill_down", td.with_views(f"""
SELECT ord, family, niche, {_fill_sql('niche', 'family', 'ord', 'down')} AS niche_down,
       {_fill_sql('length_max', 'family', 'ord', 'up')} AS length_max_up
FROM tm""", "tm"))
def fill_down(spark: SparkSession, sf_dir: str):
    """W1 variants: down-only and up-only fills grouped by a nullable key (NA is a group)."""
    t = td.tm(spark, sf_dir).select("ord", "family", "niche", "length_max")
    t = t.withColumn("niche_down", F.col("niche")).withColumn("length_max_up", F.col("length_max"))
    t = windows.fill(t, ["niche_down", "length_max_up"], ["family"], ["ord"],
                     {"niche_down": "down", "length_max_up": "up"})
    return t.drop("length_max")


@register("split_fill_reunite", td.with_views(f"""
SELECT ord, higher_taxon, family, {_fill_sql('length_min')} AS length_min, {_fill_sql('length_max')} AS length_max
FROM tm WHERE higher_taxon IN ({_FILL_IN})
UNION ALL
SELECT ord, higher_taxon, family, length_min, length_max
FROM tm WHERE higher_taxon IS NULL OR higher_taxon NOT IN ({_FILL_IN})""", "tm"))
def split_fill_reunite(spark: SparkSession, sf_dir: str):
    """Back-fill only the listed groups, keep the rest (incl. NA groups), bind rows."""
    t = td.tm(spark, sf_dir).select("ord", "higher_taxon", "family", "length_min", "length_max")
    filled = windows.fill(t.filter(is_in("higher_taxon", FILL_GROUPS)), ["length_min", "length_max"],
                          ["higher_taxon"], ["ord"], "downup")
    rest = t.filter(not_in("higher_taxon", FILL_GROUPS))
    return setops.bind_rows(filled, rest)


# ----------------------------------------------------------------------------------- first / extremes
_LI_ORDER = ("l_linenumber, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")


@register("first_per_group", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LI_ORDER}) AS rn FROM lineitem) t
WHERE rn = 1""")
def first_per_group(spark: SparkSession, sf_dir: str):
    """The first line of each order by line number, ties broken by the other columns."""
    li = td.table(spark, sf_dir, "lineitem")
    return windows.first_per_group(li, ["l_orderkey"], ["l_linenumber"])


@register("group_min_max", td.with_views("""
SELECT ord, higher_taxon, family,
       min(length_min) OVER (PARTITION BY higher_taxon, family) AS length_min,
       max(length_max) OVER (PARTITION BY higher_taxon, family) AS length_max
FROM tm""", "tm"))
def group_min_max(spark: SparkSession, sf_dir: str):
    """Grouped min / max written back to every row; all-NA group gives NULL (not +-Inf)."""
    t = td.tm(spark, sf_dir).select("ord", "higher_taxon", "family", "length_min", "length_max")
    return windows.with_group_extremes(t, ["higher_taxon", "family"], mins=["length_min"], maxs=["length_max"])


# ---------------------------------------------------------------------------------------------- reshape
@register("unpivot_small", td.with_views("""
SELECT ord, family, name, value FROM tm
UNPIVOT INCLUDE NULLS (value FOR name IN (length_min, length_max))""", "tm"))
def unpivot_small(spark: SparkSession, sf_dir: str):
    """R2: named columns to long, NULL values kept."""
    t = td.tm(spark, sf_dir).select("ord", "family", "length_min", "length_max")
    return reshape.unpivot_columns(t, ["ord", "family"], ["length_min", "length_max"], "name", "value")


@register("unpivot_regex", td.with_views("""
SELECT ord, niche_original, value FROM tm
UNPIVOT INCLUDE NULLS (value FOR niche_original IN (length_min, length_max, score_a, score_b))
WHERE value IS NOT NULL""", "tm"))
def unpivot_regex(spark: SparkSession, sf_dir: str):
    """Columns picked by regex to long, then ``drop_na(value)``."""
    t = td.tm(spark, sf_dir).select("ord", "length_min", "length_max", "score_a", "score_b")
    long = reshape.unpivot_columns(t, ["ord"], columns.matching(t, "score|length"), "niche_original", "value")
    return filters.drop_na(long, ["value"])


_SAMPLES = list(range(16))  # every remainder there is: no row falls outside


@register("explode_wide_counts", """
SELECT l_partkey AS cluster, 's' || CAST(l_orderkey % 16 AS VARCHAR) AS sample,
       CAST(sum(l_quantity) AS BIGINT) AS reads
FROM lineitem GROUP BY l_partkey, l_orderkey % 16 HAVING sum(l_quantity) > 0""")
def explode_wide_counts(spark: SparkSession, sf_dir: str):
    """A wide cluster x sample count matrix back to long, zero / absent cells dropped before expansion."""
    li = td.table(spark, sf_dir, "lineitem").withColumn("sample", F.pmod("l_orderkey", F.lit(16)))
    # the input matrix: one row per cluster, one count column per sample
    wide = (li.groupBy(F.col("l_partkey").alias("cluster"))
            .pivot("sample", _SAMPLES).agg(F.sum("l_quantity").cast("bigint")))
    wide = wide.toDF("cluster", *[f"s{i}" for i in _SAMPLES])
    return reshape.explode_wide(wide, ["cluster"], None, "sample", "reads", keep=lambda v: v > 0)


@register("pivot_ranks", """
WITH cls AS (
  SELECT DISTINCT user_id AS taxon_key, event_type AS rank, event_type || '_' || CAST(user_id % 3 AS VARCHAR) AS name
  FROM events WHERE event_type IN ('click', 'view', 'purchase'))
SELECT taxon_key, max(CASE WHEN rank = 'click' THEN name END) AS click,
       max(CASE WHEN rank = 'view' THEN name END) AS "view",
       max(CASE WHEN rank = 'purchase' THEN name END) AS purchase
FROM cls GROUP BY taxon_key""")
def pivot_ranks(spark: SparkSession, sf_dir: str):
    """Long (taxon, rank, name, id) -> keep ranks -> drop id -> distinct -> one column per rank."""
    ev = td.table(spark, sf_dir, "events")
    cls = ev.select(F.col("user_id").alias("taxon_key"), F.col("event_type").alias("rank"),
                    F.concat_ws("_", F.col("event_type"), (F.col("user_id") % 3).cast("string")).alias("name"),
                    F.col("event_id").alias("id"))
    ranks = ["click", "view", "purchase"]
    kept = filters.filter_in(cls, "rank", ranks).drop("id").distinct()
    return reshape.pivot_fixed(kept, ["taxon_key"], "rank", "name", ranks)


@register("separate_pieces", """
SELECT p_partkey, string_split(p_name, ' ')[1] AS w1, string_split(p_name, ' ')[2] AS w2,
       string_split(p_name, ' ')[3] AS w3
FROM part""")
def separate_pieces(spark: SparkSession, sf_dir: str):
    """Split into a fixed set of columns; missing pieces NULL."""
    p = td.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return reshape.separate(p, "p_name", ["w1", "w2", "w3"], " ")


@register("separate_url", """
SELECT page_id, string_split(url, '/')[1] AS scheme, string_split(url, '/')[3] AS host,
       string_split(url, '/')[4] AS section
FROM pages""")
def separate_url(spark: SparkSession, sf_dir: str):
    """Extra pieces dropped (URL path tail), blank piece kept as ''."""
    p = td.table(spark, sf_dir, "pages").select("page_id", "url")
    return reshape.separate(p, "url", ["scheme", "blank", "host", "section"], "/").drop("blank")


# ------------------------------------------------------------------------------------------- aggregates
@register("frequency_table", """
SELECT event_type, count(*) AS n_clusters
FROM (SELECT CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type FROM events) e
WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY event_type""")
def frequency_table(spark: SparkSession, sf_dir: str):
    """A5: ``table(x)``: NA excluded, ascending value order."""
    ev = td.table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type"))
    return aggregates.frequency_table(ev, "event_type", "event_type", "n_clusters")


@register("distinct_rows", """
SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem""")
def distinct_rows(spark: SparkSession, sf_dir: str):
    """A1: row de-duplication over all (selected) columns."""
    return td.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag").distinct()


@register("row_missing_count", td.with_views("""
SELECT ord, higher_taxon, family,
  CAST((length_min IS NULL) AS INTEGER) + CAST((length_max IS NULL) AS INTEGER)
  + CAST((niche IS NULL) AS INTEGER) + CAST((sub_family IS NULL) AS INTEGER)
  + CAST((family IS NULL) AS INTEGER) + CAST((higher_taxon IS NULL) AS INTEGER) AS n_missing
FROM tm""", "tm"))
def row_missing_count(spark: SparkSession, sf_dir: str):
    """``rowSums(is.na(.))`` over every column of the selection, keys included."""
    cols = ["higher_taxon", "family", "sub_family", "length_min", "length_max", "niche"]
    t = td.tm(spark, sf_dir).select("ord", *cols)
    return aggregates.with_missing_count(t, cols=cols).select("ord", "higher_taxon", "family", "n_missing")


@register("missing_by_group", td.with_views("""
, m AS (
  SELECT higher_taxon,
    CAST((length_min IS NULL) AS INTEGER) + CAST((length_max IS NULL) AS INTEGER)
    + CAST((niche IS NULL) AS INTEGER) + CAST((family IS NULL) AS INTEGER) AS n_missing
  FROM tm)
SELECT higher_taxon, count(*) AS n_missing_families, CAST(sum(n_missing) AS BIGINT) AS total_missing_attributes
FROM m WHERE n_missing > 0 GROUP BY higher_taxon
ORDER BY n_missing_families DESC, higher_taxon""", "tm"))
def missing_by_group(spark: SparkSession, sf_dir: str):
    """Per order, rows with missing cells and total missing cells, largest first."""
    t = td.tm(spark, sf_dir).select("higher_taxon", "family", "length_min", "length_max", "niche")
    return aggregates.missing_by_group(aggregates.with_missing_count(t), "higher_taxon")


@register("missing_patterns", td.with_views("""
SELECT length_min IS NULL AS length_min, length_max IS NULL AS length_max, niche IS NULL AS niche,
       sub_family IS NULL AS sub_family, count(*) AS n
FROM tm GROUP BY ALL""", "tm"))
def missing_patterns(spark: SparkSession, sf_dir: str):
    """A10: every observed missing / present combination with its frequency (the VIM ``aggr`` table)."""
    t = td.tm(spark, sf_dir)
    return aggregates.missing_patterns(t, ["length_min", "length_max", "niche", "sub_family"])


@register("missing_share", td.with_views("""
SELECT avg(CAST((length_min IS NULL) AS DOUBLE)) AS length_min, avg(CAST((length_max IS NULL) AS DOUBLE)) AS length_max,
       avg(CAST((niche IS NULL) AS DOUBLE)) AS niche, avg(CAST((sub_family IS NULL) AS DOUBLE)) AS sub_family
FROM tm""", "tm"))
def missing_share(spark: SparkSession, sf_dir: str):
    """A10: share of missing cells per column (one row)."""
    return aggregates.missing_share(td.tm(spark, sf_dir), ["length_min", "length_max", "niche", "sub_family"])


# --------------------------------------------------------------------------------------------- filters
@register("filters_eq_ne_in_notin", td.with_views("""
SELECT ord, higher_taxon, family, niche FROM tm
WHERE niche <> 'PROMO'
  AND (family IS NULL OR family NOT IN ('small ring', 'red widget', 'blue bolt'))
  AND coalesce(sub_family IN ('ring', 'widget', 'gear', 'bolt'), false)
  AND higher_taxon = higher_taxon""", "tm"))
def filters_eq_ne_in_notin(spark: SparkSession, sf_dir: str):
    """``!=`` drops NA, ``%in%`` never NA, ``!%in%`` keeps NA."""
    t = td.tm(spark, sf_dir).select("ord", "higher_taxon", "family", "sub_family", "niche")
    t = t.filter(F.col("niche") != "PROMO")
    t = filters.filter_not_in(t, "family", ["small ring", "red widget", "blue bolt"])
    t = filters.filter_in(t, "sub_family", ["ring", "widget", "gear", "bolt"])
    return t.filter(F.col("higher_taxon") == F.col("higher_taxon")).drop("sub_family")


@register("regex_filter", """
SELECT p_partkey, p_name, p_type FROM part
WHERE regexp_matches(p_name, 'ring|gear') AND NOT regexp_matches(p_type, 'LARGE|PROMO')""")
def regex_filter(spark: SparkSession, sf_dir: str):
    """Unanchored, case-sensitive regex keep / drop."""
    p = td.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return p.filter(F.col("p_name").rlike("ring|gear")).filter(~F.col("p_type").rlike("LARGE|PROMO"))


@register("flag_filter", td.with_views("""
SELECT ord, family, length_min, length_max FROM tm
WHERE (length_min IS NOT NULL OR length_max IS NOT NULL) AND family IS NOT NULL
  AND CASE WHEN niche IS NULL THEN NULL ELSE niche IN ('SMALL', 'MEDIUM', 'LARGE') END""", "tm"))
def flag_filter(spark: SparkSession, sf_dir: str):
    """Not-missing, disjunction of not-missing, boolean flag column (NULL flag dropped)."""
    t = td.tm(spark, sf_dir)
    t = t.withColumn("flag", F.col("niche").isin("SMALL", "MEDIUM", "LARGE"))
    t = t.filter(F.col("length_min").isNotNull() | F.col("length_max").isNotNull())
    t = t.filter(F.col("family").isNotNull())
    return filters.keep_flag(t, "flag").select("ord", "family", "length_min", "length_max")


@register("any_missing", td.with_views("""
SELECT ord, length_min, length_max, niche FROM tm
WHERE length_min IS NULL OR length_max IS NULL OR niche IS NULL""", "tm"))
def any_missing(spark: SparkSession, sf_dir: str):
    """keep rows with any missing value among regex-selected columns."""
    t = td.tm(spark, sf_dir).select("ord", "length_min", "length_max", "niche")
    return filters.keep_any_missing(t, columns.matching(t, ["length", "niche"]))


@register("complete_cases", td.with_views("""
SELECT ord, higher_taxon, family, length_min, length_max, niche FROM tm
WHERE family IS NOT NULL AND length_min IS NOT NULL AND length_max IS NOT NULL AND niche IS NOT NULL""", "tm"))
def complete_cases(spark: SparkSession, sf_dir: str):
    """complete cases without one column."""
    t = td.tm(spark, sf_dir).select("ord", "higher_taxon", "family", "sub_family", "length_min", "length_max",
                                    "niche")
    return filters.drop_na(t.drop("sub_family"))


@register("complete_cases_except", td.with_views("""
SELECT ord, higher_taxon, family, sub_family, length_min, length_max, niche FROM tm
WHERE family IS NOT NULL AND length_min IS NOT NULL AND length_max IS NOT NULL AND niche IS NOT NULL""", "tm"))
def complete_cases_except(spark: SparkSession, sf_dir: str):
    """``drop_na(-sub_family)``: sub_family may be NA and is kept."""
    t = td.tm(spark, sf_dir).select("ord", "higher_taxon", "family", "sub_family", "length_min", "length_max",
                                    "niche")
    return filters.drop_na_except(t, ["sub_family"])


# ----------------------------------------------------------------------------------------------- union
@register("union_by_name", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_mktsegment AS mktsegment,
       CAST(NULL AS VARCHAR) AS note FROM customer
UNION ALL
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, NULL AS mktsegment,
       CAST(NULL AS VARCHAR) AS note FROM supplier""")
def union_by_name(spark: SparkSession, sf_dir: str):
    """Bind rows by name; columns absent from one frame NULL; typed NULL constant column."""
    c = td.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("mktsegment"), columns.null_column("note"))
    s = td.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nationkey"),
        columns.null_column("note"))
    return setops.bind_rows(c, s)
