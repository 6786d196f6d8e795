"""bench.py is the driver's per-round measurement: it must print one JSON line."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import SF01

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF01, BENCH_CPUS="4", BENCH_REPEATS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.01 and d["value"] > 0
    assert set(d["queries"]) == set(d["rows"]) and len(d["queries"]) >= 10
    assert d["rows"]["erp_layout_m"] == 3024
