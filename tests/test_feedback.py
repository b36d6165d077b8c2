from pyspark.sql import functions as F
import datetime as dt

import pandas as pd
import pytest

from faultline.operators import feedback as FB
from faultline.operators.joins import Dim
from faultline.sources.tables import upsert_by_key
from tests.conftest import rows


@pytest.fixture(scope="module")
def fact(spark):
    data = [(10, "s1", "WHERE", "q10"), (3, "s1", "JOIN", "q3"), (7, "s2", "WHERE", "q7"),
            (1, "s2", "HAVING", "q1"), (2, "s2", "WHERE", "q2"), (5, "s3", "JOIN", "q5")]
    return spark.createDataFrame(data, "submission_id int, subtype string, concept string, query string")


def test_first_example_per_group(fact):
    got = sorted(rows(FB.first_example_per_group(fact, "subtype", "submission_id", ["concept", "query"]),
                      "subtype", "submission_id", "concept", "query"))
    assert got == [("s1", 3, "JOIN", "q3"), ("s2", 1, "HAVING", "q1"), ("s3", 5, "JOIN", "q5")]


def test_worklist_ranks_examples_and_prompt(spark, fact):
    names = spark.createDataFrame([("s1", "missing quotes"), ("s2", "undefined column")], "subtype string, name string")
    wl = FB.feedback_worklist(fact, "subtype", 2, "submission_id",
                              "Pattern {name} ({frequency}x), concept {concept}:\n{query}",
                              {"name": "name", "frequency": "frequency", "concept": "concept", "query": "query"},
                              example_columns=["concept", "query"],
                              group_dims=[Dim(names, on="subtype", columns=["name"])])
    got = rows(wl, "frequency_rank", "subtype", "frequency", "example_id", "prompt")
    assert got == [(1, "s2", 3, 1, "Pattern undefined column (3x), concept HAVING:\nq1"),
                   (2, "s1", 2, 3, "Pattern missing quotes (2x), concept JOIN:\nq3")]


def test_enrich_rows_skips_failures(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "boom"), (3, "fine")], "id int, prompt string")

    def service(s: pd.Series) -> pd.Series:
        if (s == "boom").any():
            raise RuntimeError("service unavailable")
        return s.str.upper()

    kept = FB.enrich_rows(df.coalesce(1), service, "prompt")
    assert sorted(rows(kept, "id", "response")) == [(1, "OK"), (3, "FINE")]
    every = FB.enrich_rows(df.coalesce(1), service, "prompt", drop_failed=False)
    errs = {r.id: r.error for r in every.collect()}
    assert errs[1] is None and errs[2].startswith("RuntimeError")


def test_upsert_insert_update_keep_and_idempotent(spark):
    t0 = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(1, "a", 5, t0), (2, "b", 7, t0)], "fid long, key string, freq long, at timestamp_ntz")
    new = spark.createDataFrame([("b", 9), ("c", 1)], "key string, freq long")
    now = dt.datetime(2024, 2, 2)
    once = upsert_by_key(old, new, "key", id_col="fid", touched_col="at", now=now)
    got = sorted(rows(once))
    assert got == [(1, "a", 5, t0), (2, "b", 9, now), (3, "c", 1, now)]
    twice = upsert_by_key(once, new, "key", id_col="fid", touched_col="at", now=now)
    assert sorted(rows(twice)) == got
    pruned = upsert_by_key(old, new, "key", id_col="fid", touched_col="at", now=now, prune=True)
    assert sorted(r[1] for r in rows(pruned)) == ["b", "c"]


def test_upsert_last_write_wins_or_rejects(spark):
    old = spark.createDataFrame([("a", 1)], "key string, v long")
    new = spark.createDataFrame([("a", 2, 1), ("a", 3, 2)], "key string, v long, seq int")
    got = rows(upsert_by_key(old, new, "key", order_col="seq"), "key", "v")
    assert got == [("a", 3)]
    with pytest.raises(Exception):
        upsert_by_key(old, new.drop("seq"), "key").collect()


def test_feedback_report_preview(spark):
    res = spark.createDataFrame([(2, "s1", "x" * 100), (1, "s2", "short")], "rank long, subtype string, text string")
    got = rows(FB.feedback_report(res, "rank", "text", ["subtype"], preview_chars=70))
    assert got == [(1, "s2", "short"), (2, "s1", "x" * 70)]


def test_feedback_job_twice_keeps_ids_and_refreshes(spark, fact):
    from faultline.session import scratch_path

    def service(s: pd.Series) -> pd.Series:
        return "  Check " + s.str.len().astype(str) + " chars.\n"

    args = dict(fact=fact, group="subtype", n=2, order_col="submission_id",
                template="{subtype}: {query}", fields={"subtype": "subtype", "query": "query"},
                service=service, model_name="pure", example_columns=["query"],
                now=dt.datetime(2024, 3, 1))
    v1 = scratch_path(spark, "fb_v1")
    r1 = rows(FB.feedback_job(out_path=v1, **args))
    assert r1 == [(1, "s2", 3, "Check 6 chars."), (2, "s1", 2, "Check 6 chars.")]
    v2 = scratch_path(spark, "fb_v2")
    r2 = rows(FB.feedback_job(out_path=v2, table_path=v1, **args))
    assert r2 == r1
    ids1 = dict(rows(spark.read.parquet(v1), "subtype", "feedback_id"))
    ids2 = dict(rows(spark.read.parquet(v2), "subtype", "feedback_id"))
    assert ids1 == ids2 and sorted(ids1.values()) == [1, 2]


def test_enrich_rows_ignores_the_returned_index(spark):
    df = spark.createDataFrame([(1, "a"), (2, "bb"), (3, "ccc")], "id int, prompt string").coalesce(1)

    def shuffled_index(s: pd.Series) -> pd.Series:
        return pd.Series((s.str.len()).tolist(), index=list(reversed(range(len(s)))))

    got = sorted(rows(FB.enrich_rows(df, shuffled_index, "prompt", materialize=False), "id", "response"))
    assert got == [(1, "1"), (2, "2"), (3, "3")]


def test_per_row_service_and_pause(spark):
    import time as _time

    df = spark.createDataFrame([(1, "a"), (2, "bb")], "id int, prompt string").coalesce(1)
    t0 = _time.time()
    got = sorted(rows(FB.enrich_rows(df, FB.per_row(lambda p: p.upper()), "prompt", pause_seconds=0.5,
                                     materialize=False), "id", "response"))
    assert got == [(1, "A"), (2, "BB")]
    assert _time.time() - t0 >= 0.5


def test_many_prompts_use_many_tasks_and_paused_calls_take_their_time(spark):
    import time
    df = spark.range(60).selectExpr("CAST(id AS string) AS p").orderBy("p").limit(60)
    t0 = time.time()
    done = FB.enrich_rows(df, FB.per_row(lambda p: "r" + p), "p", pause_seconds=0.1, tasks=3)
    assert {r.p: r.response for r in done.collect()} == {str(i): f"r{i}" for i in range(60)}
    assert time.time() - t0 >= 60 * 0.1 / 3 * 0.9
    parts = FB.enrich_rows(df, FB.per_row(lambda p: p), "p", tasks=3, materialize=False)
    assert parts.select(F.spark_partition_id()).distinct().count() == 3


def test_a_failing_prompt_repeats_no_other_call(spark, tmp_path):
    def service(p):
        (tmp_path / f"{p}-{len(list(tmp_path.glob(p + '-*')))}").touch()
        if p == "3":
            raise RuntimeError("no")
        return p
    df = spark.range(8).selectExpr("CAST(id AS string) AS p")
    got = FB.enrich_rows(df, FB.per_row(service), "p", drop_failed=False, tasks=2)
    assert {r.p for r in got.collect() if r.error} == {"3"}
    assert len(list(tmp_path.iterdir())) == 8


def test_a_batch_function_may_report_failures_by_row(spark):
    def service(prompts):
        return [ValueError("odd") if int(p) % 2 else p for p in prompts]
    got = FB.enrich_rows(spark.range(6).selectExpr("CAST(id AS string) AS p"), service, "p", drop_failed=False)
    assert {r.p for r in got.collect() if r.error == "ValueError: odd"} == {"1", "3", "5"}
