"""Calls are made once: across equal inputs, runs, failures and lost workers."""

import datetime as dt
import os
import subprocess
import sys
import tempfile

import pandas as pd

from faultline.operators import calls as C
from faultline.operators import feedback as FB
from faultline.session import scratch_path
from faultline.sources import keyed as K
from tests.conftest import rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def counting(folder, fail=()):
    """A one-prompt service that leaves a file per call."""
    def service(p):
        (folder / f"{p}-{len(list(folder.glob(p + '-*')))}").touch()
        if p in fail:
            raise RuntimeError("no")
        return p.upper()
    return C.per_row(service)


def test_equal_inputs_and_later_runs_call_once(spark, tmp_path):
    log = scratch_path(spark, "log")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None)], "id int, p string")
    first = C.logged_calls(df.filter("id < 3"), counting(tmp_path), "p", log)
    assert sorted(rows(first, "id", "response")) == [(1, "A"), (2, "B")]
    again = C.logged_calls(df.unionByName(spark.createDataFrame([(5, "c")], df.schema)), counting(tmp_path), "p", log, drop_failed=False)
    assert sorted(rows(again, "id", "response", "error")) == [
        (1, "A", None), (2, "B", None), (3, "A", None), (4, None, "no input"), (5, "C", None)]
    assert sorted(f.name for f in tmp_path.iterdir()) == ["a-0", "b-0", "c-0"]
    other = C.logged_calls(df.filter("id = 1"), counting(tmp_path), "p", log, model="another")
    assert rows(other, "response") == [("A",)] and (tmp_path / "a-1").exists()  # a model of its own answers


def test_failures_are_called_again_and_answers_are_not(spark, tmp_path):
    log = scratch_path(spark, "log")
    df = spark.createDataFrame([(x,) for x in "abcd"], "p string")
    some = C.logged_calls(df, counting(tmp_path, fail="bd"), "p", log, drop_failed=False)
    assert sorted(rows(some, "p", "response", "error")) == [
        ("a", "A", None), ("b", None, "RuntimeError: no"), ("c", "C", None), ("d", None, "RuntimeError: no")]
    assert sorted(rows(C.logged_calls(df, counting(tmp_path, fail="d"), "p", log), "p")) == [("a",), ("b",), ("c",)]
    assert sorted(f.name for f in tmp_path.iterdir()) == ["a-0", "b-0", "b-1", "c-0", "d-0", "d-1"]


def test_batches_and_names_and_nothing(spark):
    log = scratch_path(spark, "log")
    df = spark.createDataFrame([(i, f"p{i}", "x", "y") for i in range(7)], "id int, p string, response string, _n string")
    got = C.logged_calls(df, lambda s: "r" + s, "p", log, calls_per_commit=3)
    assert got.columns == ["id", "p", "_n", "response", "error"]
    assert sorted(rows(got, "p", "response")) == [(f"p{i}", f"rp{i}") for i in range(7)]
    assert len([f for f in spark.read.parquet(log).inputFiles()]) >= 3  # a file a task: committed apart
    assert C.logged_calls(df.limit(0), lambda s: s, "p", scratch_path(spark, "log")).count() == 0


def test_feedback_job_with_a_log_calls_once(spark, tmp_path):
    fact = spark.createDataFrame([(10, "s1", "q10"), (3, "s1", "q3"), (7, "s2", "q7"), (1, "s2", "q1"), (2, "s2", "q2")],
                                 "submission_id int, subtype string, query string")
    args = dict(fact=fact, group="subtype", n=2, order_col="submission_id", template="{query}", fields={"query": "query"},
                service=counting(tmp_path), example_columns=["query"], now=dt.datetime(2024, 3, 1), log_path=scratch_path(spark, "log"))
    v1, v2 = scratch_path(spark, "v1"), scratch_path(spark, "v2")
    report = rows(FB.feedback_job(out_path=v1, **args))
    assert report == [(1, "s2", 3, "Q1"), (2, "s1", 2, "Q3")]
    assert rows(FB.feedback_job(out_path=v2, table_path=v1, **args)) == report
    assert sorted(f.name for f in tmp_path.iterdir()) == ["q1-0", "q3-0"]


def test_feedback_runs_over_one_folder(spark, tmp_path):
    def fact(extra=()):
        return spark.createDataFrame([(10, "s1", "q10"), (3, "s1", "q3"), (7, "s2", "q7"), (1, "s2", "q1"), (2, "s2", "q2"), *extra],
                                     "submission_id int, subtype string, query string")
    args = dict(group="subtype", n=2, order_col="submission_id", template="{query}", fields={"query": "query"},
                service=counting(tmp_path), example_columns=["query"], store_path=scratch_path(spark, "store"), partitions=4)
    first = rows(FB.feedback_run(fact(), now=dt.datetime(2024, 3, 1), **args))
    assert first == [(1, "s2", 3, "Q1"), (2, "s1", 2, "Q3")]
    more = [(i, "s3", f"q{i}") for i in range(20, 25)]  # a new pattern, ahead of the others
    assert rows(FB.feedback_run(fact(more), now=dt.datetime(2024, 4, 1), **args)) == [(1, "s3", 5, "Q20"), (2, "s2", 3, "Q1")]
    assert sorted(f.name for f in tmp_path.iterdir()) == ["q1-0", "q20-0", "q3-0"]
    table = K.open_keyed(spark, args["store_path"] + "/results")
    stored = {r["subtype"]: (r["feedback_id"], r["frequency_rank"], r["generated_at"].month) for r in K.read_keyed(spark, table).collect()}
    assert stored == {"s1": (1, 2, 3), "s2": (2, 2, 4), "s3": (3, 1, 4)}  # s1 keeps its row, ids are kept


KILLED = """
import os, sys
sys.path.insert(0, {root!r})
from faultline.session import get_spark, shared_dir
from faultline.operators.calls import logged_calls, per_row
folder, log = sys.argv[1], sys.argv[2]
spark = get_spark("local[1,{attempts}]", partitions=4)
shared_dir(spark)

def service(p):
    if p == "p3" and {kill}(os.path.join(folder, "killed")):
        open(os.path.join(folder, "killed"), "w").close()
        os._exit(1)  # the worker is lost before the service has answered
    with open(os.path.join(folder, "calls"), "a") as f:
        f.write(p + "\\n")
    return p.upper()

df = spark.createDataFrame([(f"p{{i}}",) for i in range(6)], "p string")
try:
    print("GOT", sorted(r.response for r in logged_calls(df, per_row(service), "p", log).collect()))
except Exception as e:
    print("FAILED", type(e).__name__)
"""


def _run(folder, log, attempts, kill):
    code = KILLED.format(root=ROOT, attempts=attempts, kill=kill)
    out = subprocess.run([sys.executable, "-c", code, str(folder), str(log)], capture_output=True, text=True, timeout=600,
                         cwd=tempfile.mkdtemp(prefix="calls-cwd-"))
    return out.stdout.strip().splitlines()[-1] if out.stdout.strip() else out.stderr[-2000:]


def test_a_lost_worker_and_a_failed_job_repeat_no_call(tmp_path):
    every = "GOT " + str([f"P{i}" for i in range(6)])
    retried = tmp_path / "retried"
    retried.mkdir()
    assert _run(retried, tmp_path / "log1", 2, "not os.path.exists") == every  # the task is tried again
    assert sorted((retried / "calls").read_text().split()) == [f"p{i}" for i in range(6)]
    failed = tmp_path / "failed"
    failed.mkdir()
    assert _run(failed, tmp_path / "log2", 1, "not os.path.exists").startswith("FAILED")  # the job is lost
    before = (failed / "calls").read_text().split() if (failed / "calls").exists() else []
    logged = pd.read_parquet(tmp_path / "log2")["input"].tolist()
    assert sorted(logged) == sorted(before) and "p3" not in before
    assert _run(failed, tmp_path / "log2", 1, "not os.path.exists") == every
    assert sorted((failed / "calls").read_text().split()) == [f"p{i}" for i in range(6)]
