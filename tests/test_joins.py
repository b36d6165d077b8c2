from pyspark.sql import functions as F

from faultline.operators.analysis import difficulty_rank, frequency_by_keys
from faultline.operators.joins import Dim, attach, fits, fits_each
from tests.conftest import rows


def _star(spark):
    fact = spark.createDataFrame(
        [(i, i % 4, i % 3, "x" if i % 5 else "y") for i in range(200)], "id long, a long, b long, cat string")
    da = spark.createDataFrame([(k, f"A{k % 2}") for k in range(4)], "ak long, a_name string")
    db = spark.createDataFrame([(k, f"B{k}", f"T{k % 2}") for k in range(3)], "bk long, b_name string, t string")
    dims = [Dim(da, on="a", key="ak", columns=["a_name"]), Dim(db, on="b", key="bk", columns=["b_name", "t"])]
    return fact, dims


def test_fits_is_a_bounded_count(spark):
    df = spark.range(100)
    assert fits(df, 100) and not fits(df, 99) and not fits(df, None)
    assert fits_each([spark.range(3), spark.range(10)], 5) == [True, False]


def test_broadcast_and_eager_aggregation_agree(spark):
    fact, dims = _star(spark)
    small = frequency_by_keys(fact, ["a_name", "b_name", "t"], dims)
    large = frequency_by_keys(fact, ["a_name", "b_name", "t"], dims, broadcast_max_rows=0)
    assert rows(small) == rows(large)
    assert sum(r[-1] for r in rows(small)) == 200


def test_eager_path_preaggregates(spark):
    fact, dims = _star(spark)
    got, w = attach(fact, dims, keep=[], broadcast_max_rows=0)
    assert w.weight == "_w"
    assert got.agg(F.sum("_w")).first()[0] == 200
    assert got.count() <= 12


def test_difficulty_rank_same_on_both_paths(spark):
    fact, dims = _star(spark)
    args = dict(key="a_name", distinct="b", category="cat", categories={"x": "x_count", "y": "y_count"})
    a = rows(difficulty_rank(fact, dims=dims, **args))
    b = rows(difficulty_rank(fact, dims=dims, broadcast_max_rows=0, **args))
    assert a == b
