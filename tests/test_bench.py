"""bench.py prints exactly one JSON line with the documented keys."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(
        os.environ,
        BENCH_SF_DIR=SF_SMALL,
        BENCH_WARMUP_DIR=SF_SMALL,
        BENCH_REPEAT="1",
        BENCH_CPUS="2",
        BENCH_DRIVER_MEMORY="2g",
    )
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "top_k", "share_of_total"],
        capture_output=True,
        text=True,
        env=env,
        timeout=600,
        check=True,
    )
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    record = json.loads(lines[0])
    assert record["unit"] == "sec" and record["sf"] == 0.001 and record["failed"] == []
    assert set(record["queries"]) == {"top_k", "share_of_total"}
    assert record["value"] == round(sum(record["queries"].values()), 3)
