"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "family_reads", "union_by_name"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    report = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(report)
    assert report["unit"] == "sec" and report["sf"] == 0.001
    assert set(report["queries"]) == {"family_reads", "union_by_name"}
