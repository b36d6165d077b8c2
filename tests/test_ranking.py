import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from faultline.operators.ranking import rank_rows, sequence_ids


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice([None] + list(range(12))), rnd.randint(0, 5)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a int, b int")


def test_rank_matches_window_rank_with_ties_and_nulls(spark):
    df = _data(spark)
    order = [("a", False), ("b", True)]
    got = rank_rows(df, order, out="r", partitions=5)
    ref = df.withColumn("ref", F.rank().over(Window.orderBy(F.col("a").desc_nulls_last(), F.col("b"))))
    joined = got.join(ref, "id")
    assert joined.filter(F.col("r") != F.col("ref")).count() == 0
    assert got.count() == df.count()


def test_row_number_is_a_permutation_in_order(spark):
    df = _data(spark, 2000, seed=3)
    got = rank_rows(df, ["b", "id"], out="rn", method="row_number", partitions=7)
    res = sorted((r.rn, r.b, r.id) for r in got.collect())
    assert [r[0] for r in res] == list(range(1, 2001))
    keys = [(r[1], r[2]) for r in res]
    assert keys == sorted(keys)


def test_rank_on_empty_and_single_row(spark):
    empty = spark.createDataFrame([], "k int")
    assert rank_rows(empty, ["k"]).count() == 0
    one = spark.createDataFrame([(5,)], "k int")
    assert [r["rank"] for r in rank_rows(one, ["k"]).collect()] == [1]


def test_one_hot_key_holding_a_third_of_rows(spark):
    rows = [(i, 0 if i % 3 == 0 else i) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k long")
    got = {r.id: r["rank"] for r in rank_rows(df, ["k"], partitions=6).collect()}
    assert got[0] == 1 and got[3] == 1
    assert got[1] == 1001  # 1000 rows share k = 0


def test_rank_rows_with_a_map_column(spark):
    df = spark.createDataFrame([(1, {"a": 1}), (2, {"b": 2}), (2, {"c": 3})], "k int, m map<string,int>")
    assert sorted(r["rank"] for r in rank_rows(df, [("k", False)]).collect()) == [1, 1, 3]
    got = sorted(r["rn"] for r in rank_rows(df, [("k", False)], out="rn", method="row_number").collect())
    assert got == [1, 2, 3]


def test_sequence_ids_follow_files_and_positions(spark):
    """Files of unequal size, the smallest first: Spark packs them by size, ids follow their names."""
    from faultline.operators.ranking import sequence_ids
    from faultline.session import scratch_path

    path, start = scratch_path(spark, "seq"), 0
    for i, n in enumerate((3, 4000, 10, 900)):
        spark.range(start, start + n, 1, 1).write.parquet(f"{path}/part={i}")
        start += n
    df = spark.read.parquet(path).select(F.col("id").alias("v")).filter("v % 2 = 0")
    got = [(r.n, r.v) for r in sequence_ids(df, "n").collect()]
    assert sorted(got) == [(k + 1, 2 * k) for k in range(len(got))] and len(got) == (start + 1) // 2
    backwards = sequence_ids(df, "n", order=[("v", False)])
    assert sorted((r.n, r.v) for r in backwards.collect())[0] == (1, start - 1 - (start - 1) % 2)
    assert [r.n for r in sequence_ids(spark.range(3), "n").orderBy("id").collect()] == [1, 2, 3]


def test_row_numbers_do_not_depend_on_the_layout(spark):
    rows_ = [(i % 3, f"r{i}") for i in range(200)]
    a = spark.createDataFrame(rows_, "k int, s string").repartition(1)
    b = spark.createDataFrame(rows_[::-1], "k int, s string").repartition(7, "s")
    numbered = [sorted((r.n, r.s) for r in rank_rows(x, ["k"], out="n", method="row_number").collect()) for x in (a, b)]
    assert numbered[0] == numbered[1]


def test_identical_rows_spread_over_partitions(spark):
    df = spark.createDataFrame([(1, "same")] * 6000 + [(2, f"r{i}") for i in range(2000)], "k int, s string").repartition(4)
    got = rank_rows(df, ["k"], out="n", method="row_number", partitions=8)
    sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(r.n for r in got.collect()) == list(range(1, 8001)) and max(sizes) < 3000


def test_rank_with_a_third_of_rows_identical(spark):
    rows_ = [(7, "same")] * 1000 + [(i % 50, f"r{i}") for i in range(2000)]
    df = spark.createDataFrame(rows_, "k int, s string").repartition(6)
    got = rank_rows(df, [("k", False)], partitions=5).collect()
    assert len(got) == 3000
    ranks = {}
    for r in got:
        ranks.setdefault(r.k, set()).add(r["rank"])
    assert all(len(v) == 1 for v in ranks.values())
    counts = {k: sum(1 for x in rows_ if x[0] == k) for k in ranks}
    for k, (rk,) in ((k, tuple(v)) for k, v in ranks.items()):
        assert rk == 1 + sum(c for kk, c in counts.items() if kk > k)


def test_file_ids_move_no_row_and_follow_files_of_any_size(spark, tmp_path):
    """Files of unequal size, packed into tasks by size, kept rows only."""
    want = []
    for name, n in (("a", 5), ("b", 30000), ("c", 1), ("d", 0), ("e", 700)):
        df = spark.range(n).selectExpr("id AS pos", f"'{name}' AS f", "repeat('x', 50) AS pad")
        df.coalesce(1).write.parquet(f"{tmp_path}/t/{name}")
        want += [(name, i) for i in range(n) if i % 3]
    df = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/t").filter("pos % 3 <> 0").select("f", "pos")
    df.sparkSession.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        numbered = sequence_ids(df, "seq")
        got = [(r["f"], r["pos"]) for r in sorted(numbered.collect(), key=lambda r: r["seq"])]
        ids = sorted(r["seq"] for r in numbered.collect())
        plan = numbered._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == want and ids == list(range(1, len(want) + 1))
    rows_side = plan[:plan.index("BroadcastExchange")]
    assert "rangepartitioning" not in plan and "hashpartitioning" not in rows_side  # only a row per block is exchanged
