"""Plan-shape guard over every registered query: no cartesian products, no Python evaluation (but for the
readers of raw files), and each nested-loop join is the 'right side is empty' check against one row of its own."""

import os

import pytest

import __spark_entry__ as entry
from ecospark.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

#: Queries that read lines or broken files by place, which Spark's readers cannot.
READERS = {"classification_files", "fread_file", "wide_tsv_counts"}


@pytest.mark.parametrize("name", sorted(n for n in entry.queries() if n in catalog.QUERIES))
def test_plan_shape(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan, name
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, (name, node)
    if name not in READERS:
        assert "MapInArrow" not in plan, name
    loops = [ln for ln in plan.splitlines() if "BroadcastNestedLoopJoin" in ln]
    assert all("BuildRight, LeftAnti" in ln for ln in loops) and len(loops) <= plan.count("LocalLimit 1"), (name, loops)


def test_flagship_scan_is_pruned_and_filtered(spark):
    df = entry.queries()["family_reads"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(ln for ln in plan.splitlines() if "FileScan" in ln and "l_quantity" in ln)
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double>" in scan, scan
    assert "PushedFilters: [IsNotNull(l_quantity)" in scan, scan
