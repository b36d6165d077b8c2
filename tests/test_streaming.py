from faultline.operators.prepare import classify_by_keywords
from faultline.session import scratch_path, shared_dir
from tests.conftest import rows


def test_stateless_operators_run_on_a_stream(spark):
    src = scratch_path(spark, "stream_queries")
    spark.createDataFrame([(1, "SELECT a FROM t WHERE b"), (2, "select x from (select y from z)")],
                          "id int, q string").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("id int, q string").parquet(src)
    q = (classify_by_keywords(stream, "q").writeStream.format("memory").queryName("classified")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert sorted(rows(spark.table("classified"), "id", "concept")) == [(1, "WHERE"), (2, "SUBQUERY")]


def test_shared_dir_uses_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    d = shared_dir(spark)
    assert d and (configured is None or configured.rstrip("/").split(":")[-1] in d)
