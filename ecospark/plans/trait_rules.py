"""Rule tables of the trait compilation, as data.

Fixed values: every name, threshold and pattern below must equal the original recipe for identical results,
including its spelling slips ("Phytophate-parasitoid", "Aranea", "Predators"), which are kept on purpose
(see SURVEY D3, D4).  They are listed in the order the recipe evaluates them: first match wins.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values: synonyms (recode)
HIGHER_TAXON_SYNONYMS = {
    "Auchenorrhyncha": "Hemiptera",
    "Sternorrhyncha": "Hemiptera",
    "Heteroptera": "Hemiptera",
    "Dictyoptera": "Blattodea",
    "Psocoptera": "Psocodea",
}
FAMILY_SYNONYMS = {"Trogositidae": "Trogossitidae"}

# older recipe: no Dictyoptera / Psocoptera mapping on the larval table, and the opposite Blattodea mapping
HIGHER_TAXON_SYNONYMS_V1 = {
    "Auchenorrhyncha": "Hemiptera",
    "Sternorrhyncha": "Hemiptera",
    "Heteroptera": "Hemiptera",
}
FEEDING_SYNONYMS_V1 = {"Blattodea": "Dictyoptera"}

# ---------------------------------------------------------------- fixed values: threshold fills
NICHE_FILL = [
    ([("saprophagous", 0.5)], "Saprophagous"),
    ([("zoophagous", 0.5)], "Predator"),
    ([("phytophagous", 0.5)], "Phytophagous"),
]
HABITAT_FILL = [
    ([("larva_aquatic", 0.5)], "Water"),
    ([("phytophagous", 0.5)], "Plants"),
    ([("mycetophagous", 0.5)], "Fungi"),
    ([("coprophagous", 0.5)], "Temporary habitats"),
    ([("saproxylic", 0.5), ("phytophagous", 0.5)], "Wood"),
    ([("roots", 0.5)], "Soil"),
]

# ---------------------------------------------------------------- fixed values: overrides (column, value, new niche)
NICHE_OVERRIDES = [
    ("sub_family", "Mymarommatidae", "Phytophage-parasitoid"),
    ("sub_family", "Pyrgotidae", "Saprophage-parasitoid"),
    ("sub_family", "Eucharitidae", "Phytophage-parasitoid"),
    ("sub_family", "Stephanidae", "Phytophate-parasitoid"),
    ("sub_family", "Mantispidae", "Predator"),
    ("sub_family", "Cryptochetidae", "Phytophate-parasitoid"),
    ("sub_family", "Eginiidae", "Saprophage-parasitoid"),
    ("sub_family", "Leucospidae", "Phytophage-parasitoid"),
    ("higher_taxon", "Aranea", "Predators"),
]
NICHE_OVERRIDES_V1 = NICHE_OVERRIDES[:-1]
HIGHER_TAXON_OVERRIDES = [("family", "Isotomidae", "Entomobryomorpha")]

# ---------------------------------------------------------------- fixed values: soil feeding table
SOIL_NICHE_COLUMNS = "fungi|bacteriv|litter|root|plant|algal|predator|parasit"
SOIL_NICHE_CATEGORIES = [
    ("fungi|bacteriv|litter|root|algal", "Saprophagous"),
    ("plant", "Phytophagous"),
    ("predator", "Predator"),
    ("parasitic", "Parasite"),
]
SOIL_FAMILY_OVERRIDES = [
    ("family", "Acaridae", "Saprophagous"),
    ("family", "Heterosminthurus", "Saprophagous"),
]
SOIL_CLASSES = ["Arachnida", "Collembola"]
SOIL_RANKS = ["Kingdom", "Phylum", "Class", "Order", "Family", "Genus", "Species"]
SOIL_FAMILY_SUFFIX = "_environmental_sample"
SOIL_DROP_COLUMNS = ["x6", "x16", "all_inclusive"]

# ---------------------------------------------------------------- fixed values: other recipe constants
BACKFILL_ORDERS = ["Protura", "Raphidioptera", "Siphonaptera", "Strepsiptera"]
SUBFAMILY_FAMILIES = ["Braconidae", "Ichneumonidae", "Staphylinidae"]
CLASSIFICATION_RANKS = ["family", "subfamily", "genus"]
NICHE_LEVELS = ["Phytophagous", "Predator", "Saprophagous", "Phytophage-parasitoid", "Predator-parasitoid",
                "Saprophage-parasitoid"]
NICHE_EXCLUDE = "General|Parasite"
MITE_LENGTH_CLASSES = ["length_1", "length_1_5", "length_5_10", "length_10"]
EXPERT_EXCLUDED_FAMILY = "Ichneumonidae"
LARVAL_JUNK_ROWS = (587, 602)
LARVAL_DROPPED_COLUMN = 29
LARVAL_SCORE_COLUMNS = (4, 28)
LARVAL_KEY_COLUMNS = (1, 2)
ARTHROPOD_PHYLUM = "Arthropoda"
