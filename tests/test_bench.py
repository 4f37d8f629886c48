"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMOKE


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMOKE, "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, str(ROOT / "bench.py"), "courier_ledger_prev_month", "upsert_by_key"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {
        "courier_ledger_prev_month", "upsert_by_key"}
    assert rec["value"] == round(sum(rec["queries"].values()), 3) or abs(
        rec["value"] - sum(rec["queries"].values())) < 0.01
