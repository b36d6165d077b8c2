"""The driver's view: bench output and the entry module from elsewhere."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

DRIVER = """
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry_mod", {entry!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
assert m.entry(spark).count() > 0
rows = m.queries()["enrich_rows"](spark, "/root/testdata/sf0.001").collect()
assert len(rows) == 3 and all(r.response.startswith("reviewed: ") for r in rows)
assert set(m.oracle_sql()) <= set(m.queries())
print("OK")
"""


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "top_n_ranked", "value_counts"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=tempfile.gettempdir())
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and set(rec["queries"]) == {"top_n_ranked", "value_counts"}
    assert rec["value"] > 0 and rec["sf"] == "0.001"


def test_entry_module_from_another_directory():
    code = DRIVER.format(entry=os.path.join(ROOT, "__spark_entry__.py"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env,
                         timeout=600, cwd=tempfile.mkdtemp(prefix="driver-cwd-"))
    assert out.stdout.strip().endswith("OK"), out.stderr[-2000:]


WITHOUT = """
import importlib.abc, importlib.util, sys

class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {hidden!r}:
            raise ImportError(name + " is hidden")

sys.meta_path.insert(0, Hidden())
spec = importlib.util.spec_from_file_location("entry_mod", {entry!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
print(len(m.queries()), any(k.startswith("op") and k[2].isdigit() for k in m.queries()), "pipeline" in m.queries())
"""


def test_entry_module_without_the_optional_parts():
    from faultline.plans import loads, registered  # noqa: F401

    for hidden in ("faultline.llm", "public_tokenizers", "zstandard"):
        code = WITHOUT.format(hidden=hidden, entry=os.path.join(ROOT, "__spark_entry__.py"))
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=600, cwd=tempfile.gettempdir())
        assert out.stdout.split() == [str(len(registered.QUERIES)), "False", "False"], out.stderr[-2000:]
