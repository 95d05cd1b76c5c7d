"""bench.py prints exactly one JSON line with the keys the driver records."""
import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="fill_key,fuzzy_pairs")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, cwd=str(ROOT))
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec"
    assert set(d["queries"]) == {"fill_key", "fuzzy_pairs"} and d["sf"] == 0.001 and "errors" not in d
