"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from tests.conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert set(rec) == {"metric", "value", "unit", "queries", "sf"}
    assert rec["unit"] == "sec" and rec["sf"] == 0.001
    assert "etl_build" in rec["queries"] and "jobs_by_industry" in rec["queries"]
    assert abs(sum(rec["queries"].values()) - rec["value"]) < 0.01
