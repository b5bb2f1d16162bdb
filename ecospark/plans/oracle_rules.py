"""The rules of the trait compilation as the SQL oracles state them.

Written out in SQL and not made from ``trait_rules``, so that a wrong value in either place shows as a difference;
``tests/test_rules_decide.py`` changes them one by one and expects another result each time.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values: synonyms
ORDER_SYNONYMS = """CASE {0} WHEN 'Auchenorrhyncha' THEN 'Hemiptera' WHEN 'Sternorrhyncha' THEN 'Hemiptera'
  WHEN 'Heteroptera' THEN 'Hemiptera' WHEN 'Dictyoptera' THEN 'Blattodea' WHEN 'Psocoptera' THEN 'Psocodea' ELSE {0} END"""
ORDER_SYNONYMS_OLDER = """CASE {0} WHEN 'Auchenorrhyncha' THEN 'Hemiptera' WHEN 'Sternorrhyncha' THEN 'Hemiptera'
  WHEN 'Heteroptera' THEN 'Hemiptera' ELSE {0} END"""
FEEDING_SYNONYMS_OLDER = "CASE {0} WHEN 'Blattodea' THEN 'Dictyoptera' ELSE {0} END"
FAMILY_SYNONYMS = "CASE {0} WHEN 'Trogositidae' THEN 'Trogossitidae' ELSE {0} END"

# ---------------------------------------------------------------- fixed values: threshold fills
NICHE_FILL = """CASE WHEN main_feeding_niche IS NOT NULL THEN main_feeding_niche WHEN saprophagous > 0.5 THEN 'Saprophagous'
  WHEN zoophagous > 0.5 THEN 'Predator' WHEN phytophagous > 0.5 THEN 'Phytophagous' END"""
HABITAT_FILL = """CASE WHEN main_feeding_habitat IS NOT NULL THEN main_feeding_habitat WHEN larva_aquatic > 0.5 THEN 'Water'
  WHEN phytophagous > 0.5 THEN 'Plants' WHEN mycetophagous > 0.5 THEN 'Fungi'
  WHEN coprophagous > 0.5 THEN 'Temporary habitats' WHEN roots > 0.5 THEN 'Soil' END"""

# ---------------------------------------------------------------- fixed values: overrides
NICHE_OVERRIDES_OLDER = """CASE WHEN sub_family IN ('Mymarommatidae', 'Eucharitidae', 'Leucospidae') THEN 'Phytophage-parasitoid'
  WHEN sub_family IN ('Pyrgotidae', 'Eginiidae') THEN 'Saprophage-parasitoid'
  WHEN sub_family IN ('Stephanidae', 'Cryptochetidae') THEN 'Phytophate-parasitoid'
  WHEN sub_family = 'Mantispidae' THEN 'Predator' ELSE main_feeding_niche END"""
NICHE_OVERRIDES = """CASE WHEN sub_family IN ('Mymarommatidae', 'Eucharitidae', 'Leucospidae') THEN 'Phytophage-parasitoid'
  WHEN sub_family IN ('Pyrgotidae', 'Eginiidae') THEN 'Saprophage-parasitoid'
  WHEN sub_family IN ('Stephanidae', 'Cryptochetidae') THEN 'Phytophate-parasitoid'
  WHEN sub_family = 'Mantispidae' THEN 'Predator' WHEN higher_taxon = 'Aranea' THEN 'Predators' ELSE main_feeding_niche END"""
ORDER_OVERRIDES = "CASE WHEN family = 'Isotomidae' THEN 'Entomobryomorpha' ELSE higher_taxon END"

# ---------------------------------------------------------------- fixed values: lists
BACKFILL_ORDERS = "'Protura', 'Raphidioptera', 'Siphonaptera', 'Strepsiptera'"
NICHE_LEVELS = """'Phytophagous', 'Predator', 'Saprophagous', 'Phytophage-parasitoid', 'Predator-parasitoid',
  'Saprophage-parasitoid'"""
