
import pytest

from faultline.session import scratch_path
from faultline.sources import tables as S
from tests.conftest import rows


def test_csv_roundtrip_keeps_text_exactly(spark):
    data = [(1, 'He said "hi", then left'), (2, "line one\nline two"), (3, "  padded  "), (4, ""), (5, None),
            (6, "comma, and 'quote'")]
    df = spark.createDataFrame(data, "id int, text string")
    path = scratch_path(spark, "csv")
    S.write_csv(df, path)
    back = S.read_csv(spark, path, df.schema)
    assert sorted(rows(back), key=lambda r: r[0]) == data


def test_append_and_ids(spark):
    path = scratch_path(spark, "append")
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    S.append_rows(base, path)
    new = spark.createDataFrame([("d",), ("c",)], "name string")
    written = S.append_with_ids(spark, path, new, "id", ["name"])
    assert sorted(rows(written)) == [(3, "c"), (4, "d")]
    assert sorted(rows(spark.read.parquet(path))) == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_empty_table(spark):
    path = scratch_path(spark, "empty")
    t = S.empty_table(spark, "feedback_id long, subtype_id int, generated_feedback string", path)
    assert t.count() == 0 and t.columns == ["feedback_id", "subtype_id", "generated_feedback"]


def test_write_upsert_never_overwrites_its_input(spark):
    path = scratch_path(spark, "v1")
    spark.createDataFrame([("a", 1)], "k string, v long").write.parquet(path)
    new = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v long")
    with pytest.raises(ValueError):
        S.write_upsert(spark, path, new, "k", path)
    out = S.write_upsert(spark, path, new, "k", scratch_path(spark, "v2"))
    assert sorted(rows(out)) == [("a", 2), ("b", 3)]
    assert rows(spark.read.parquet(path)) == [("a", 1)]


def test_upsert_twice_with_null_keys_keeps_one_row_each(spark):
    from faultline.session import scratch_path
    path = scratch_path(spark, "merge")
    schema = "k string, v long, id long"
    spark.createDataFrame([(None, 5, 1), ("a", 1, 2), ("b", 1, 3)], schema).write.parquet(path)
    old = spark.read.parquet(path)
    new = spark.createDataFrame([(None, 7), ("a", 9), ("c", 4)], "k string, v long")
    once = S.upsert_by_key(old, new, "k", id_col="id", change_col="what")
    want = {(None, 7, 1, "update"), ("a", 9, 2, "update"), ("b", 1, 3, "keep"), ("c", 4, 4, "insert")}
    assert {tuple(r) for r in once.collect()} == want
    again = S.upsert_by_key(once.drop("what"), new, "k", id_col="id")
    assert {tuple(r) for r in again.collect()} == {w[:3] for w in want}
    assert {tuple(r) for r in S.upsert_by_key(old, new, "k", id_col="id", prune=True).collect()} == {w[:3] for w in want if w[3] != "keep"}


def test_table_passes_a_uri_to_spark_unchanged():
    seen = []

    class Reader:
        def parquet(self, path):
            seen.append(path)

    class Session:
        read = Reader()
    S.table(Session(), "s3a://bucket/data/", "part")
    assert seen == ["s3a://bucket/data/part.parquet"]


def test_a_new_column_shows_at_once(spark):
    from faultline.session import scratch_path
    base = scratch_path(spark, "schema")
    spark.range(2).write.parquet(f"{base}/part.parquet")
    assert S.table(spark, base, "part").columns == ["id"]
    spark.range(2).selectExpr("id", "1 AS more").write.mode("overwrite").parquet(f"{base}/part.parquet")
    assert S.table(spark, base, "part").columns == ["id", "more"]


def test_malformed_csv_fails_the_read(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\noops,3\n")
    with pytest.raises(Exception):
        S.read_csv(spark, str(tmp_path / "x.csv"), "a int, b int").collect()


def test_writers_leave_earlier_results_readable(spark):
    import __spark_entry__ as E
    first = E.queries()["append_rows"](spark, "/root/testdata/sf0.001")
    E.queries()["append_rows"](spark, "/root/testdata/sf0.001")
    assert first.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
