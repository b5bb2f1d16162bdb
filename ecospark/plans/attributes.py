"""Trait compilation (C1-C12, and the older recipe C24 as a configuration of the same functions).

Every function takes already-landed source DataFrames (see ``ecospark.sources``) with cleaned headers and
returns a lazily planned DataFrame; nothing is collected.  Sources carry an ``_ord`` column (file order) when
row order matters later (the back-fill orders rows the way R would have them after the full joins).

Trait sources are per-family tables (hundreds to thousands of rows); the cluster taxonomy joined in
``compile_attributes`` is the large input and is only ever reduced (``distinct``) before it is joined.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ecospark import functions as ef
from ecospark.operators import aggregates, columns, filters, joins, reshape, setops, windows
from ecospark.operators.columns import clean_names
from ecospark.plans import trait_rules as tr
from ecospark.sources.delimited import drop_row_range, promote_header, read_sheet, with_row_number

KEYS = ["higher_taxon", "family"]


@dataclass(frozen=True)
class TraitRecipe:
    """Switches that distinguish the current recipe from the older one."""
    trim_before_join: bool = True
    body_recode: bool = True
    body_distinct: bool = True
    larval_synonyms: dict = field(default_factory=lambda: dict(tr.HIGHER_TAXON_SYNONYMS))
    feeding_synonyms: dict = field(default_factory=lambda: dict(tr.HIGHER_TAXON_SYNONYMS))
    feeding_distinct: bool = True
    niche_overrides: tuple = tuple(tr.NICHE_OVERRIDES)
    higher_taxon_overrides: tuple = tuple(tr.HIGHER_TAXON_OVERRIDES)
    phylum_filter: str | None = tr.ARTHROPOD_PHYLUM
    with_class: bool = True


CURRENT = TraitRecipe()
V1 = TraitRecipe(trim_before_join=False, body_recode=False, body_distinct=False,
                 larval_synonyms=dict(tr.HIGHER_TAXON_SYNONYMS_V1), feeding_synonyms=dict(tr.FEEDING_SYNONYMS_V1),
                 feeding_distinct=False, niche_overrides=tuple(tr.NICHE_OVERRIDES_V1), higher_taxon_overrides=(),
                 phylum_filter=None, with_class=False)


def _numeric(df: DataFrame, c: str):
    """``as.numeric`` that leaves already-numeric columns alone."""
    return F.col(c).cast("double") if dict(df.dtypes)[c] != "string" else ef.lenient_double(c)


def _trim_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({k: ef.rtrim_unicode(k) for k in KEYS})


def distinct_first(df: DataFrame, order_col: str = "_ord") -> DataFrame:
    """``distinct()`` that keeps the first position of each distinct row (R keeps first occurrences)."""
    rest = [c for c in df.columns if c != order_col]
    return df.groupBy(*rest).agg(F.min(order_col).alias(order_col))


def _distinct(df: DataFrame) -> DataFrame:
    return distinct_first(df) if "_ord" in df.columns else df.distinct()


# ------------------------------------------------------------------------------------------- C1
def tidy_body_size(raw: DataFrame, recipe: TraitRecipe = CURRENT) -> DataFrame:
    """(taxon, length_min, length_max, reference) -> (higher_taxon, family, lengths, mass_reference)."""
    df = raw.withColumns({"length_min": _numeric(raw, "length_min"), "length_max": _numeric(raw, "length_max"),
                          "taxon": ef.replace_all("taxon", " ", "_")})
    df = df.withColumns({"higher_taxon": ef.extract_first("taxon", "^([^_]+)"),
                         "family": ef.extract_first("taxon", "(?<=_)[^_]+")})
    keep = ["_ord"] if "_ord" in df.columns else []
    df = columns.select_renamed(df, ["higher_taxon", "family", "length_min", "length_max",
                                     ("mass_reference", "reference"), *keep])
    if recipe.trim_before_join:
        df = _trim_keys(df)
    if recipe.body_recode:
        df = df.withColumn("higher_taxon", ef.recode("higher_taxon", tr.HIGHER_TAXON_SYNONYMS))
    return _distinct(df) if recipe.body_distinct else df


# ------------------------------------------------------------------------------------------- C2
def land_larval_sheet(spark, path: str, dropped_column: int = tr.LARVAL_DROPPED_COLUMN,
                      junk_rows: tuple[int, int] = tr.LARVAL_JUNK_ROWS) -> DataFrame:
    """Landed larval-niche sheet -> the frame ``tidy_larval_niche`` takes: one column goes, the first data row names
    the rest, the names are cleaned, and the block of junk rows goes; file order stays in ``_ord``.

    As with the spreadsheet reader, the first line of the sheet only names the columns (and is discarded by
    the header promotion); the real header is the first *data* row, i.e. the second line.  A single landed
    sheet is read in file order (consecutive row numbers without a single-task window).
    """
    raw = read_sheet(spark, path)
    numbered = with_row_number(raw, "_row")
    if dropped_column and dropped_column <= len(raw.columns):
        numbered = numbered.drop(f"c{dropped_column}")
    sheet = promote_header(numbered, 1)
    sheet = sheet.toDF(*clean_names(sheet.columns[:-1]), "_row")
    sheet = drop_row_range(sheet, *junk_rows)
    return sheet.withColumnRenamed("_row", "_ord")


def tidy_larval_niche(sheet: DataFrame, recipe: TraitRecipe = CURRENT,
                      score_positions: tuple[int, int] = tr.LARVAL_SCORE_COLUMNS,
                      key_positions: tuple[int, int] = tr.LARVAL_KEY_COLUMNS) -> DataFrame:
    """Promoted, cleaned, sliced larval-niche sheet -> (higher_taxon, family, score columns as DOUBLE).

    Scores and keys are one projection of the same frame, text scores becoming numbers (no positional join).
    """
    data_cols = [c for c in sheet.columns if c != "_ord"]
    lo, hi = score_positions
    scores = [data_cols[i - 1] for i in range(lo, hi + 1)]
    keys = [data_cols[i - 1] for i in range(key_positions[0], key_positions[1] + 1)]
    keep = ["_ord"] if "_ord" in sheet.columns else []
    df = sheet.select(*[(_numeric(sheet, c) if dict(sheet.dtypes)[c] == "string" else F.col(c)).alias(c)
                        for c in scores], *keys, *keep)
    df = columns.reorder_first(df, "higher_taxon", "family")
    if recipe.trim_before_join:
        df = _trim_keys(df)
    df = df.withColumn("family", ef.recode("family", tr.FAMILY_SYNONYMS))
    df = df.withColumn("higher_taxon", ef.recode("higher_taxon", recipe.larval_synonyms))
    return _distinct(df)


# ------------------------------------------------------------------------------------------- C3
def tidy_feeding_niche(raw: DataFrame, recipe: TraitRecipe = CURRENT) -> DataFrame:
    """(order, taxon_dyntaxa_2017 'Family-Subfamily', main_feeding_niche, main_feeding_habitat)."""
    keep = ["_ord"] if "_ord" in raw.columns else []
    df = columns.select_renamed(raw, [("higher_taxon", "order"), ("family", "taxon_dyntaxa_2017"),
                                      "main_feeding_niche", "main_feeding_habitat", *keep])
    # sub_family reads the unsplit family before family is overwritten (same mutate, in order)
    df = df.withColumn("sub_family", ef.nth_piece("family", "-", 2))
    df = df.withColumn("family", ef.extract_first("family", "([^-])+"))
    df = columns.select_renamed(df, ["higher_taxon", "family", "sub_family",
                                     ("main_feeding_niche", "main_feeding_niche"),
                                     ("main_feeding_habitat", "main_feeding_habitat"), *keep])
    if recipe.trim_before_join:
        df = _trim_keys(df)
    df = df.withColumn("higher_taxon", ef.recode("higher_taxon", recipe.feeding_synonyms))
    return _distinct(df) if recipe.feeding_distinct else df


# ------------------------------------------------------------------------------------------- C4
def tidy_soil_niche(raw: DataFrame) -> DataFrame:
    """C4: soil arthropod feeding table: ';'-joined taxonomy split into ranks, flag columns to long, regex
    categories, family fixes -> (higher_taxon, family, main_feeding_niche)."""
    df = raw.drop(*[c for c in tr.SOIL_DROP_COLUMNS if c in raw.columns])
    df = df.filter(ef.detect("consensus_taconomical_identity", tr.ARTHROPOD_PHYLUM))
    df = df.withColumnRenamed("consensus_taconomical_identity", "taxonomy")
    df = reshape.separate(df, "taxonomy", tr.SOIL_RANKS, ";")
    df = filters.drop_na(df, ["Family"])
    flag_cols = columns.matching(df.drop(*tr.SOIL_RANKS), tr.SOIL_NICHE_COLUMNS)
    ids = [c for c in df.columns if c not in flag_cols]
    df = reshape.unpivot_columns(df, ids, flag_cols, "niche_original", "value", "string")
    df = filters.drop_na(df, ["value"])
    df = filters.filter_in(df, "Class", tr.SOIL_CLASSES)
    df = df.withColumn("main_feeding_niche", ef.regex_category("niche_original", tr.SOIL_NICHE_CATEGORIES))
    df = df.withColumn("Family", ef.remove_first("Family", tr.SOIL_FAMILY_SUFFIX))
    df = df.withColumn("main_feeding_niche",
                       ef.first_match([(F.col("Family") == F.lit(v), new) for _, v, new in tr.SOIL_FAMILY_OVERRIDES],
                                      default=F.col("main_feeding_niche")))
    keep = ["_ord"] if "_ord" in df.columns else []
    return df.select(F.col("Order").alias("higher_taxon"), F.col("Family").alias("family"),
                     "main_feeding_niche", *keep)


# --------------------------------------------------------------------------------------- C5-C7
def tidy_expert_general(raw: DataFrame) -> DataFrame:
    """General expert table: drop sequencing columns, numeric lengths, at least one category, no
    Ichneumonidae (NA family dropped too, as ``!=`` does)."""
    df = raw.drop(*[c for c in ("n_otu", "n_obs", "reads", "in_checklist") if c in raw.columns])
    df = df.withColumns({"length_min": _numeric(df, "length_min"), "length_max": _numeric(df, "length_max")})
    df = df.filter(F.col("main_feeding_niche").isNotNull() | F.col("main_feeding_habitat").isNotNull())
    return df.filter(F.col("family") != F.lit(tr.EXPERT_EXCLUDED_FAMILY))


def tidy_expert_spiders(raw: DataFrame) -> DataFrame:
    """Spider expert table; the source spells the column ``lenght_max``."""
    return columns.select_renamed(raw, ["higher_taxon", "family", "length_min", ("length_max", "lenght_max"),
                                        *columns.matching(raw, "main")])


def tidy_expert_mites(raw: DataFrame) -> DataFrame:
    """Mite / springtail table: body-length *classes* turned into min / max values, one row per family.

    Needs ``_ord`` (file order): R keeps the first row per (higher_taxon, family) in file order, then in class
    order (``length_1``, ``length_1_5``, ``length_5_10``, ``length_10``).
    """
    df = distinct_first(raw)
    df = df.drop(*[c for c in ("x13", "comment") if c in df.columns])
    df = columns.cast_matching(df, "length_m", lambda c: ef.lenient_double(c))
    df = windows.with_group_extremes(df, KEYS, mins=["length_min"], maxs=["length_max"])
    df = distinct_first(df)
    classes = list(tr.MITE_LENGTH_CLASSES)
    ids = [c for c in df.columns if c not in classes]
    long = reshape.unpivot_columns(df, ids, classes, "new_length", "value", "string")
    long = long.withColumn("__class_pos", ef.level_index("new_length", classes))
    long = filters.drop_na(long, ["value"])
    long = long.withColumn("new_length", ef.remove_first("new_length", "length_"))
    long = reshape.separate(long, "new_length", ["new_length_min", "new_length_max"], "_")
    long = long.withColumns({
        "length_min": F.coalesce(F.col("length_min"), ef.lenient_double("new_length_min")),
        "length_max": F.coalesce(F.col("length_max"), ef.lenient_double("new_length_max")),
    })
    long = long.withColumn("length_max", F.when((F.col("length_min") == 1) & F.col("length_max").isNull(), F.lit(1.0))
                           .otherwise(F.col("length_max")))
    long = long.withColumn("higher_taxon", ef.remove_first("higher_taxon", r".*,\s"))
    sel = long.select(*KEYS, "length_min", "length_max", "main_feeding_niche",
                      "main_feeding_habitat", "_ord", "__class_pos")
    first = windows.first_per_group(sel, KEYS, ["_ord", "__class_pos"])
    return first.drop("__class_pos", "_ord").distinct()


# ------------------------------------------------------------------------------------------- C8
def merge_sources(body: DataFrame, larval: DataFrame, feeding: DataFrame, soil: DataFrame | None,
                  recipe: TraitRecipe = CURRENT) -> DataFrame:
    """Three chained null-safe full joins, then the ordered rule tables.

    Each source's ``_ord`` is kept under its own name so that later order-dependent steps can order rows the
    way the R frame was ordered (x rows first, then y-only rows).
    """
    def tag(df, name):
        return df.withColumnRenamed("_ord", f"_ord_{name}") if "_ord" in df.columns else df

    # per-family reference tables (bounded by the number of described families, not by sequencing volume):
    # native FULL OUTER joins, one shuffle per side
    j = joins.full_join(tag(body, "body"), tag(larval, "larval"), KEYS, strategy="native")
    j = joins.full_join(j, tag(feeding, "feeding"), KEYS, strategy="native")
    if soil is not None:
        j = joins.full_join(j, tag(soil, "soil"), KEYS + ["main_feeding_niche"], strategy="native")
    if not recipe.trim_before_join:
        j = _trim_keys(j)
    j = j.withColumns({
        "main_feeding_niche": ef.threshold_fill("main_feeding_niche", tr.NICHE_FILL),
        "main_feeding_habitat": ef.threshold_fill("main_feeding_habitat", tr.HABITAT_FILL),
    })
    j = j.withColumn("main_feeding_niche", ef.override("main_feeding_niche",
                                                               list(recipe.niche_overrides)))
    if recipe.higher_taxon_overrides:
        j = j.withColumn("higher_taxon", ef.override("higher_taxon", list(recipe.higher_taxon_overrides)))
    return j


def order_columns(df: DataFrame) -> list[str]:
    return [c for c in ("_ord_body", "_ord_larval", "_ord_feeding", "_ord_soil") if c in df.columns]


# ------------------------------------------------------------------------------------------- C9
def backfill_sizes(merged: DataFrame, orders: Sequence[str] = tr.BACKFILL_ORDERS) -> DataFrame:
    """Only the listed orders get lengths filled down-then-up within the order, in frame order."""
    order_by = order_columns(merged)
    s1 = filters.filter_not_in(merged, "higher_taxon", orders)
    # groups are orders of the per-family table (families per order are bounded): one window per order
    s2 = windows.fill(filters.filter_in(merged, "higher_taxon", orders), ["length_min", "length_max"],
                      ["higher_taxon"], order_by, "downup", strategy="window")
    return setops.bind_rows(s2, s1)


# ------------------------------------------------------------------------------------------ C10
def compile_attributes(body: DataFrame, larval: DataFrame, feeding: DataFrame, soil: DataFrame | None,
                       taxonomy: DataFrame, experts: Sequence[DataFrame] = (), recipe: TraitRecipe = CURRENT) -> DataFrame:
    """Merged, rule-filled, back-filled trait table joined to the checklist of sequenced families,
    flagged ``in_checklist``, then patched by the expert tables in priority order.

    ``taxonomy`` has columns (phylum, class, order, family, ...) - one row per sequence cluster, i.e. the
    large input; it is reduced to distinct families before any join.
    """
    merged = merge_sources(body, larval, feeding, soil, recipe)
    attributes = backfill_sizes(merged)
    taxa = taxonomy
    if recipe.phylum_filter:
        taxa = taxa.filter(F.col("phylum") == F.lit(recipe.phylum_filter))
    # explicit aliases: an uncleaned taxonomy (Class, Order, Family) must still yield the lower-case keys
    fam_cols = ([F.col("class").alias("class")] if recipe.with_class else []) + [
        F.col("order").alias("higher_taxon"), F.col("family").alias("family")]
    families = taxa.select(*fam_cols).distinct()
    out = joins.natural_join(attributes, families, how="full", strategy="native")
    out = joins.mark_join(out, families, [("family", "family")], "in_checklist")
    out = joins.patch_chain(out, experts, KEYS)
    return out.drop(*[c for c in out.columns if c.startswith("_ord")])


# ----------------------------------------------------------------------------------- C11 / C12
def missing_life_history(all_attributes: DataFrame) -> DataFrame:
    """C11: life-history columns of sequenced families."""
    sel = columns.select_matching(all_attributes, ["higher_taxon", "^family", "terrestrial", "aquatic", "in_checklist"])
    return filters.keep_flag(sel, "in_checklist")


def trait_missing_patterns(all_attributes: DataFrame) -> DataFrame:
    """Missingness patterns of the trait columns (``VIM::aggr`` table)."""
    sel = columns.drop_matching(all_attributes, ["reference", "family", "taxon", "sub_family", "in_checklist"])
    return aggregates.missing_patterns(sel, sel.columns)


def complete_case_families(all_attributes: DataFrame) -> DataFrame:
    """Families whose columns, the sub-family aside, are all there."""
    return filters.drop_na(all_attributes.drop("sub_family")).select("family")


def complete_attributes(all_attributes: DataFrame) -> DataFrame:
    """``drop_na(-sub_family)``."""
    return filters.drop_na_except(all_attributes, ["sub_family"])
