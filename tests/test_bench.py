"""bench.py prints one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys
from pathlib import Path

from .conftest import SF_SMALL

ROOT = Path(__file__).resolve().parents[1]


def test_bench_contract():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_ONLY="employee_eligibility,full_name")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    d = json.loads(out[-1])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"employee_eligibility", "full_name"}
    assert "failed" not in d
