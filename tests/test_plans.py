"""Plan-shape guards for the registered queries."""

import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {k: plan_of(fn(spark, SF)) for k, fn in E.queries().items()}


def test_no_cartesian_or_nested_loop_joins(plans):
    for k, p in plans.items():
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_python_only_in_the_enrichment_step(plans):
    for k, p in plans.items():
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k
        if "MapInPandas" in p:
            assert k in ("enrich_rows", "feedback_report"), k


def test_fact_scan_is_pruned_and_dimensions_broadcast(plans):
    p = plans["frequency_by_keys"]
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in p
    assert p.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in p


def test_category_filter_reaches_the_scan(plans):
    assert "PushedFilters: [In(event_type, [error,purchase])]" in plans["filter_categories"]


def test_top_n_is_a_bounded_top_k(plans):
    assert "TakeOrderedAndProject" in plans["top_n_ranked"]


def test_worklist_joins_examples_by_group_and_id(plans):
    p = plans["feedback_worklist"]
    assert "LeftSemi" in p and "CartesianProduct" not in p
