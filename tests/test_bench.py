"""bench.py runs end to end and prints one JSON line (smallest driver tables)."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF, "BENCH_CPUS": "2", "BENCH_REPEATS": "1"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    record = json.loads(lines[0])
    assert record["unit"] == "sec" and record["sf"] == 0.001
    assert record["value"] == pytest.approx(sum(record["queries"].values()), rel=1e-6, abs=0.01)
    assert {"gd_documents_1000ep", "synth_1m_x20_gram_first", "q_compare"} <= set(record["queries"])
