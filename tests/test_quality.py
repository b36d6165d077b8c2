import pytest
from pyspark.sql import functions as F

from faultline.operators import quality as Q
from tests.conftest import rows


def test_null_counts_and_violations(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "a", None), (None, None, "z")], "a int, b string, c string")
    assert sorted(rows(Q.null_counts(df))) == [("a", 1), ("b", 2), ("c", 1)]
    assert Q.null_violations(df, ["a", "c"]).count() == 2


def test_unique_and_fk(spark):
    child = spark.createDataFrame([(1, 10), (2, 10), (2, 11), (3, None), (4, 99)], "id int, p int")
    parent = spark.createDataFrame([(10, "x"), (11, "y"), (12, "z")], "pid int, name string")
    assert rows(Q.unique_violations(child, "id")) == [(2, 2)]
    assert rows(Q.fk_violations(child, parent, "p", "pid"), "id") == [(4,)]  # NULL key is no violation
    assert sorted(rows(Q.restrict_delete_blocked(parent, child, "pid", "p"), "pid")) == [(10,), (11,)]
    deleted = parent.filter(F.col("pid") == 10)
    assert sorted(rows(Q.cascade_delete(child, deleted, "p", "pid"), "id")) == [(2,), (3,), (4,)]


def test_range_and_length(spark):
    df = spark.createDataFrame([(1, 0, "abcde"), (2, 1, "abcdef"), (3, 4, "ab"), (4, 5, ""), (5, None, None)],
                               "id int, score int, s string")
    assert sorted(rows(Q.range_violations(df, "score", 1, 4), "id")) == [(1,), (4,)]
    assert rows(Q.length_violations(df, "s", 5), "id", "length") == [(2, 6)]


def test_cascade_rekey_keeps_every_child(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "id int, k int")
    m = spark.createDataFrame([(10, 110), (12, 112)], "old_key int, new_key int")
    assert sorted(rows(Q.cascade_rekey(child, m, "k"))) == [(1, 110), (2, 11), (3, 112)]


def test_functional_dependency(spark):
    df = spark.createDataFrame([("s1", "syntax"), ("s1", "schema"), ("s2", "syntax"), ("s2", "syntax")],
                               "sub string, typ string")
    assert rows(Q.functional_dependency(df, "sub", "typ")) == [("s1", 2)]


def test_profile_columns_ties_go_to_smallest_value(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("b", 2), ("a", None)], "s string, n int")
    got = rows(Q.profile_columns(df))
    assert got == [("n", 3, 2, "1", 2), ("s", 4, 2, "a", 2)]
    assert rows(Q.profile_shape(df)) == [(4, 2)]
    assert rows(Q.schema_info(df)) == [("s", "string", 4), ("n", "int", 3)]


def test_head_rows_is_ordered(spark):
    df = spark.createDataFrame([(i,) for i in (5, 3, 9, 1, 7, 2)], "k int")
    assert rows(Q.head_rows(df, "k", 3)) == [(1,), (2,), (3,)]


def test_constraint_report_on_the_declared_model(spark):
    import datetime as dt

    from faultline.sources.schemas import CONSTRAINTS, SCHEMAS

    data = {
        "ErrorType": [(1, "syntax"), (2, "schema"), (3, "syntax")],                  # duplicate name
        "ErrorSubtype": [(1, "missing quotes", 1), (2, "x" * 101, 9)],               # too long, orphan
        "Emotion": [(1, "anger")],
        "SQLConcept": [(1, "WHERE")],
        "LearningOutcome": [(1, "Use quotes for text."), (1, "again")],              # duplicate id
        "Submission": [(1, "SELECT 1", 1, 1, 1, 1, "msg"), (2, "SELECT 2", 2, 1, 1, 7, "msg")],  # orphan outcome
        "LLMFeedback": [(1, 1, 1, "m", "p", "f", 1, 2, dt.datetime(2024, 1, 1))],
        "FeedbackEvaluation": [(1, 1, "r", "clarity", 4), (2, 1, "r", "tone", 5), (3, 2, "r", "tone", 1)],
    }
    tables = {t: spark.createDataFrame(rows_, SCHEMAS[t]) for t, rows_ in data.items()}
    report = {(t, k, c): v for t, k, c, v in rows(Q.constraint_report(tables, CONSTRAINTS))}
    assert report[("ErrorType", "unique", "type_name")] == 1
    assert report[("ErrorSubtype", "max_length", "subtype_name")] == 1
    assert report[("ErrorSubtype", "foreign_key", "error_type_id")] == 1
    assert report[("LearningOutcome", "primary_key", "outcome_id")] == 1
    assert report[("Submission", "foreign_key", "outcome_id")] == 1
    assert report[("FeedbackEvaluation", "between", "score")] == 1
    assert report[("FeedbackEvaluation", "foreign_key", "feedback_id")] == 1
    bad = {k for k, v in report.items() if v}
    assert len(bad) == 7 and len(report) == len(CONSTRAINTS)


def test_orphan_keys_count_child_rows(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, 99), (4, None)], "id int, p int")
    parent = spark.createDataFrame([(10,)], "pid int")
    assert rows(Q.orphan_keys(child, parent, "p", "pid")) == [(99, 2)]


def test_enforce_before_append(spark):
    import pytest

    from faultline.sources.schemas import CONSTRAINTS, SCHEMAS

    feedback = spark.createDataFrame([], SCHEMAS["LLMFeedback"])
    ok = spark.createDataFrame([(1, 1, "r", "tone", 4)], SCHEMAS["FeedbackEvaluation"])
    bad = spark.createDataFrame([(1, 1, "r", "tone", 5)], SCHEMAS["FeedbackEvaluation"])
    row_level = [c for c in CONSTRAINTS if c.table == "FeedbackEvaluation" and c.kind != "foreign_key"]
    Q.enforce({"FeedbackEvaluation": ok, "LLMFeedback": feedback}, row_level)
    with pytest.raises(ValueError, match="between"):
        Q.enforce({"FeedbackEvaluation": bad, "LLMFeedback": feedback}, row_level)


def test_constraints_on_missing_tables_are_an_error(spark):
    with pytest.raises(ValueError, match="not given: nowhere"):
        Q.constraint_report({"t": spark.range(1)}, [Q.Constraint("t", "foreign_key", ("id",), ("nowhere", ("id",)))])


def test_constraint_report_scans_each_table_once(spark, tmp_path):
    spark.createDataFrame([(1, None, "abc"), (1, 2, "abcdef"), (2, 9, "x")], "id int, ref int, s string").write.parquet(f"{tmp_path}/c")
    spark.createDataFrame([(2,), (3,)], "id int").write.parquet(f"{tmp_path}/p")
    c, p = spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/p")
    checks = [Q.Constraint("c", "primary_key", ("id",)), Q.Constraint("c", "foreign_key", ("ref",), ("p", ("id",))),
              Q.Constraint("c", "not_null", ("ref",)), Q.Constraint("c", "max_length", ("s",), 5),
              Q.Constraint("p", "primary_key", ("id",)), Q.Constraint("c", "between", ("ref",), (1, 9))]
    report = Q.constraint_report({"c": c, "p": p}, checks)
    assert {(r["table_name"], r["kind"], r["columns"]): r["violations"] for r in report.collect()} == {
        ("c", "primary_key", "id"): 1, ("c", "foreign_key", "ref"): 1, ("c", "not_null", "ref"): 1,
        ("c", "max_length", "s"): 1, ("p", "primary_key", "id"): 0, ("c", "between", "ref"): 0}
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2


def test_profile_of_a_column_of_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert [tuple(r) for r in Q.profile_columns(df).collect()] == [("a", 2, 1, "1", 2), ("b", 0, 0, None, None)]


def test_rekey_rejects_a_key_mapped_twice(spark):
    child = spark.createDataFrame([(1,), (2,)], "k int")
    mapping = spark.createDataFrame([(1, 10), (1, 11)], "old_key int, new_key int")
    with pytest.raises(Exception, match="mapped more than once"):
        Q.cascade_rekey(child, mapping, "k").collect()


def test_profile_fetches_few_values_and_shuffles_no_text(spark):
    long = "x" * 5000
    df = spark.createDataFrame([(long + "b", 1), (long + "a", 1), (long + "a", 2), (long + "b", None), ("z", 3), ("", 3)], "t string, n int")
    assert [tuple(r) for r in Q.profile_columns(df).collect()] == [("n", 5, 3, "1", 2), ("t", 6, 4, long + "a", 2)]
    unique = spark.range(2000).selectExpr("concat('v', id) AS v")
    assert [tuple(r) for r in Q.profile_columns(unique).collect()] == [("v", 2000, 2000, "v0", 1)]
