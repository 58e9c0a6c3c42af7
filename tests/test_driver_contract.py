"""The driver's view: the entry module loads by path from anywhere, and
bench.py prints exactly one JSON line of the agreed shape."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

LOAD_BY_PATH = """
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("spark_entry", {path!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
df = m.entry(spark)
print("ROWS", df.count(), len(m.queries()), len(m.oracle_sql()))
"""


def test_entry_loads_by_path_from_elsewhere():
    code = LOAD_BY_PATH.format(path=os.path.join(ROOT, "__spark_entry__.py"))
    out = subprocess.run(
        [sys.executable, "-c", code], cwd=tempfile.mkdtemp(), capture_output=True, text=True, timeout=300
    )
    line = [x for x in out.stdout.splitlines() if x.startswith("ROWS")]
    assert line, out.stderr[-2000:]
    _, rows, nq, no = line[0].split()
    assert int(rows) > 0 and int(nq) >= int(no) > 0


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], cwd=ROOT, env=env, capture_output=True, text=True, timeout=900
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, lines
    res = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(res)
    assert res["unit"] == "sec" and res["sf"] == 0.001
    from eventlake.plans.catalog import QUERIES

    assert set(QUERIES) <= set(res["queries"])
    assert abs(res["value"] - sum(res["queries"][k] for k in QUERIES)) < 0.01
