"""Failed task attempts are retried and the results stay exact."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import functions as F
from faultline.session import get_spark
from faultline.operators.analysis import frequency_by_keys
from faultline.operators.joins import Dim
from faultline.operators.ranking import rank_rows, sequence_ids

spark = get_spark("local[4,3]", partitions=4)
src = "/root/testdata/sf0.001/lineitem.parquet"

def flaky(batches):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    for pdf in batches:
        yield pdf

def run(fail):
    df = spark.read.parquet(src).select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity").repartition(4, "l_orderkey")
    if fail:
        df = df.mapInPandas(flaky, df.schema)
    ranked = {{tuple(r[:4]): r[4] for r in rank_rows(df, [("l_quantity", False)], out="rk").collect()}}
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    freq = sorted(tuple(r) for r in frequency_by_keys(
        df, ["p_type"], [Dim(part, on="l_partkey", key="p_partkey", columns=["p_type"])],
        broadcast_max_rows=0).collect())
    ids = sorted(r[0] for r in sequence_ids(spark.read.parquet(src)).collect())
    return ranked, freq, ids

clean, retried = run(False), run(True)
assert clean == retried, "results differ after retries"
assert clean[2] == list(range(1, len(clean[2]) + 1))
print("OK")
"""


def test_results_survive_task_retries():
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], capture_output=True, text=True,
                         timeout=900, cwd=tempfile.mkdtemp(prefix="retry-cwd-"))
    assert out.stdout.strip().endswith("OK"), out.stderr[-3000:]
    assert "injected task failure" in out.stderr
