"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(res)
    assert res["unit"] == "sec" and res["sf"] == 0.001
    assert res["value"] == res["queries"]["train_score_accuracy"] > 0
