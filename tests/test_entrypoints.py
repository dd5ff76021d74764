"""The scripts the driver and users run: bench.py prints one JSON line; the CLI answers --help."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_REPEAT="1", BENCH_CPUS="2")
    out = subprocess.run(
        [sys.executable, "bench.py", "table_counts", "mean_by"],
        cwd=ROOT, env=env, capture_output=True, text=True, timeout=600, check=True,
    )
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"table_counts", "mean_by"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=1e-3)


def test_cli_help():
    out = subprocess.run([sys.executable, "-m", "zonekit", "--help"], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "report" in out.stdout and "etl1" in out.stdout
