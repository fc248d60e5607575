"""bench.py prints one JSON line with the expected fields (sf0.001, 1 repeat)."""

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_REPEAT="1", BENCH_MEM="2g")
    out = subprocess.run([sys.executable, "bench.py"], cwd=root, env=env, capture_output=True,
                         text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and rec["value"] > 0
    assert {"ledger", "stuffing", "leakage", "route", "risk_score"} <= set(rec["queries"])
