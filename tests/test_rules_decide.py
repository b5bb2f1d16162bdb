"""Every rule value decides rows of the compiled table: the oracle with one value changed gives another result.  With the
recipe equal to the oracle (test_queries), a wrong value in ``trait_rules`` cannot pass."""

import os
import re

import pytest

from oracle import duck
from ecospark.plans import attributes, oracle_rules, queries_composite

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

CURRENT = ["ORDER_SYNONYMS", "FAMILY_SYNONYMS", "NICHE_FILL", "HABITAT_FILL", "NICHE_OVERRIDES", "ORDER_OVERRIDES", "BACKFILL_ORDERS"]
OLDER = ["ORDER_SYNONYMS_OLDER", "FEEDING_SYNONYMS_OLDER", "FAMILY_SYNONYMS", "NICHE_FILL", "HABITAT_FILL",
         "NICHE_OVERRIDES_OLDER", "BACKFILL_ORDERS"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def digest(con, recipe):
    sql = queries_composite.trait_sql(recipe, recipe is attributes.CURRENT, recipe is attributes.CURRENT)
    return con.execute(f"SELECT count(*), sum(CAST(hash(t) AS HUGEINT)) FROM ({sql}) t").fetchone()


@pytest.mark.parametrize("recipe, names", [(attributes.CURRENT, CURRENT), (attributes.V1, OLDER)], ids=["current", "older"])
def test_each_value_changes_the_result(con, monkeypatch, recipe, names):
    right = digest(con, recipe)
    idle = []
    for name in names:
        text = getattr(oracle_rules, name)
        for value in re.finditer(r"'[^']+'|0\.5", text):
            new = "0.4" if value.group() == "0.5" else "'changed'"
            monkeypatch.setattr(oracle_rules, name, text[:value.start()] + new + text[value.end():])
            if digest(con, recipe) == right:
                idle.append((name, value.group()))
        monkeypatch.setattr(oracle_rules, name, text)
    assert idle == []


def test_sources_are_read_whole():
    """No source leaves rows of its table out: the only conditions are on groups already built."""
    sources = queries_composite.tt.SOURCES_SQL
    assert re.findall(r"FROM part\s+WHERE", sources) == []
    assert all(queries_composite.tt._parts_sql(s) in sources for s in ("body", "larval", "feeding", "soil", "expert"))
