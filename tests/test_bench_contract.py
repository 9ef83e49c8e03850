"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="move_column,left_enrich", BENCH_WARMUP="0")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    data = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(data)
    assert data["unit"] == "sec" and data["sf"] == 0.001
    assert set(data["queries"]) == {"move_column", "left_enrich"}
