"""Queries of repeated loads and runs on the driver's test tables: calls that
are not repeated, merges into a part of a table, checks of new rows alone,
stable ids, sketches that are united, a view that is read.

They are registered beside those of :mod:`registered`.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analysis as A
from ..operators import feedback as FB
from ..operators import prepare as P
from ..operators import text as TX
from ..operators.calls import call_id, logged_calls, read_log
from ..operators.inserts import build_index, insert_report
from ..operators.quality import Constraint
from ..session import scratch_path
from ..sources import keyed as K
from ..sources.tables import next_ids
from .registered import DOC_TEMPLATE, ORACLE_SQL, _SNOWFLAKE_FROM, _t, q_difficulty_rank, register, review_service


@register("logged_calls", """
SELECT conv_id, turn, 'reviewed: ' || CAST(length(text) AS VARCHAR) || ' characters' AS response, CAST(1 AS BIGINT) AS calls
FROM conversations WHERE text IS NOT NULL
""")
def q_logged_calls(spark, sf):
    """Every conversation text reviewed in two runs over one log: the first
    turns, then all; ``calls`` is how often the log has the text."""
    conv = _t(spark, sf, "conversations").select("conv_id", "turn", "text")
    log = scratch_path(spark, "call_log")
    logged_calls(conv.filter("turn = 0"), review_service, "text", log, calls_per_commit=500).count()
    done = logged_calls(conv, review_service, "text", log, calls_per_commit=500)
    calls = read_log(spark, log).groupBy("call_id").agg(F.count(F.lit(1)).alias("calls"))
    return (done.withColumn("call_id", call_id("text")).join(calls, "call_id")
            .select("conv_id", "turn", "response", "calls"))


@register("feedback_run", ORACLE_SQL["feedback_report"])
def q_feedback_run(spark, sf):
    """The feedback job twice over one folder of results and calls: a first run
    of one pattern, then all three."""
    fields = {"frequency_rank": "frequency_rank", "frequency": "frequency", "lang": "lang", "source": "source", "text": "text"}
    store = scratch_path(spark, "feedback_store")
    docs = _t(spark, sf, "documents")
    for n in (1, 3):
        report = FB.feedback_run(docs, "lang", n, "doc_id", DOC_TEMPLATE, fields, review_service, store,
                                 model_name="review-service", example_columns=["source", "text"])
    return report


@register("keyed_merge", """
WITH f AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS order_id FROM orders WHERE o_orderstatus = 'F'),
n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) + (SELECT COUNT(*) FROM f) AS order_id
      FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F')
SELECT order_id, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM f
UNION ALL SELECT order_id, o_orderkey, o_totalprice FROM n
""")
def q_keyed_merge(spark, sf):
    """Finished orders stored by key; the others inserted and the urgent ones'
    prices doubled in one merge."""
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    finished = F.col("o_orderstatus").eqNullSafe(F.lit("F"))
    none = spark.createDataFrame([], "order_id long")
    base = next_ids(none, orders.filter(finished).select("o_orderkey", "o_totalprice"), "order_id", ["o_orderkey"])
    table = K.create_keyed(base, scratch_path(spark, "orders_keyed"), "o_orderkey", partitions=16, id_col="order_id")
    price = F.when(finished, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))
    load = orders.filter(~finished | (F.col("o_orderpriority") == "1-URGENT")).select("o_orderkey", price.alias("o_totalprice"))
    K.merge_keyed(spark, table, load)
    return K.read_keyed(spark, table)


@register("insert_report", """
WITH n AS (SELECT * FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'
           UNION ALL SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'),
o AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'),
p AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT 'primary_key' AS kind, 'o_orderkey' AS columns, (SELECT COUNT(*) FROM (
    SELECT o_orderkey FROM n WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey
    HAVING COUNT(*) > 1 OR o_orderkey IN (SELECT o_orderkey FROM o))) AS violations
UNION ALL SELECT 'foreign_key', 'o_custkey', (SELECT COUNT(*) FROM n WHERE o_custkey IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM p WHERE c_custkey = o_custkey))
UNION ALL SELECT 'not_null', 'o_orderdate', (SELECT COUNT(*) FROM n WHERE o_orderdate IS NULL)
UNION ALL SELECT 'between', 'o_totalprice', (SELECT COUNT(*) FROM n WHERE o_totalprice NOT BETWEEN 1000 AND 300000)
UNION ALL SELECT 'max_length', 'o_orderpriority', (SELECT COUNT(*) FROM n WHERE length(o_orderpriority) > 8)
""")
def q_insert_report(spark, sf):
    """New orders checked against the keys of the finished ones and of some
    customers: only the new rows and the key indexes are read."""
    orders, customers = _t(spark, sf, "orders"), _t(spark, sf, "customer")
    finished = F.col("o_orderstatus").eqNullSafe(F.lit("F"))
    indexes = {
        ("orders", ("o_orderkey",)): build_index(orders.filter(finished), "o_orderkey", scratch_path(spark, "orders_keys"), 32),
        ("customer", ("c_custkey",)): build_index(customers.filter("c_mktsegment <> 'BUILDING'"), "c_custkey",
                                                  scratch_path(spark, "customer_keys"), 32)}
    new = orders.filter(~finished).unionAll(orders.filter("o_orderpriority = '1-URGENT'"))
    return insert_report(new, [
        Constraint("orders", "primary_key", ("o_orderkey",)),
        Constraint("orders", "foreign_key", ("o_custkey",), ("customer", ("c_custkey",))),
        Constraint("orders", "not_null", ("o_orderdate",)), Constraint("orders", "between", ("o_totalprice",), (1000, 300000)),
        Constraint("orders", "max_length", ("o_orderpriority",), 8)], indexes)


@register("dimension_extended", """
WITH m AS (SELECT MIN(doc_id) + MAX(doc_id) AS s FROM documents),
a AS (SELECT DISTINCT source FROM documents, m WHERE doc_id * 2 < m.s AND source IS NOT NULL AND source < 'src2'),
b AS (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL AND source NOT IN (SELECT source FROM a))
SELECT ROW_NUMBER() OVER (ORDER BY source) AS source_id, source, 1 AS load FROM a
UNION ALL SELECT ROW_NUMBER() OVER (ORDER BY source) + (SELECT COUNT(*) FROM a), source, 2 FROM b
""")
def q_dimension_extended(spark, sf):
    """The sources of a first load (some of the early documents) and those that a second one adds after them."""
    docs = _t(spark, sf, "documents").select("doc_id", "source")
    mid = docs.select(F.min("doc_id") + F.max("doc_id")).scalar()
    first = P.build_dimension(docs.filter((F.col("doc_id") * 2 < mid) & (F.col("source") < "src2")), "source", "source_id")
    path = scratch_path(spark, "sources")
    first.write.parquet(path)
    stored = spark.read.parquet(path)
    more = P.extend_dimension(stored, docs, "source", "source_id")
    return stored.withColumn("load", F.lit(1)).unionByName(more.withColumn("load", F.lit(2)))


@register("ratio_from_sketches", """
SELECT event_type, COUNT(*) AS total, COUNT(DISTINCT user_id) AS exact, TRUE AS near FROM events GROUP BY event_type
""")
def q_ratio_from_sketches(spark, sf):
    """Distinct users per event type from the sketches of two loads, united;
    ``near``: the estimate is within 5 % (three standard errors) of the exact count."""
    events = _t(spark, sf, "events").select("event_id", "event_type", "user_id")
    loads = [events.filter("event_id % 2 = 0"), events.filter("event_id % 2 <> 0 OR event_id IS NULL")]
    path = scratch_path(spark, "user_sketches")
    for load in loads:
        A.distinct_sketches(load, "event_type", "user_id").write.mode("append").parquet(path)
    united = A.united_sketches(spark.read.parquet(path), "event_type")
    ratio = A.ratio_from_sketches(united, "event_type", distinct_name="estimate")
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("exact"))
    on = F.col("event_type").eqNullSafe(F.col("_type"))
    near = F.abs(F.col("estimate") - F.col("exact")) <= F.greatest(F.col("exact") * 0.05, F.lit(1))
    return (ratio.join(exact.withColumnRenamed("event_type", "_type"), on)
            .select("event_type", "total", "exact", near.alias("near")))


@register("difficulty_view", f"""
SELECT difficulty_rank, COUNT(*) AS brands, CAST(SUM(total) AS BIGINT) AS total FROM (
    SELECT p.p_brand, COUNT(*) AS total,
           RANK() OVER (ORDER BY COUNT(*) DESC, COUNT(DISTINCT l.l_suppkey) ASC) AS difficulty_rank
    {_SNOWFLAKE_FROM} GROUP BY p.p_brand)
WHERE difficulty_rank <= 10 GROUP BY difficulty_rank
""")
def q_difficulty_view(spark, sf):
    """The view of the difficulty ranking, read by a query of its own."""
    q_difficulty_rank(spark, sf)
    return spark.sql("SELECT difficulty_rank, COUNT(*) AS brands, SUM(total) AS total FROM v_brand_difficulty "
                     "WHERE difficulty_rank <= 10 GROUP BY difficulty_rank")


@register("density_curve_binned", """
WITH v AS (SELECT CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem WHERE l_extendedprice IS NOT NULL),
s AS (SELECT COUNT(*) AS n, MIN(x) AS lo, MAX(x) AS hi, STDDEV_SAMP(x) AS sd FROM v),
p AS (SELECT n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, (hi - lo) / 199 AS step, (hi - lo) / 4096.0::DOUBLE AS width FROM s),
c AS (SELECT (x - lo) * 4096 / (hi - lo) AS a, least(floor((x - lo) * 4096 / (hi - lo)), 4095) AS cell FROM v, s),
w AS (SELECT e, SUM(w) AS w FROM (SELECT cell AS e, 1 - (a - cell) AS w FROM c UNION ALL SELECT cell + 1, a - cell FROM c) GROUP BY e),
g AS (SELECT g.range AS point, CASE WHEN g.range = 199 THEN p.hi ELSE g.range * p.step + p.lo END AS gx FROM range(200) g, p)
SELECT g.point, ROUND(g.gx, 4) AS x,
       ROUND(SUM(w.w * exp(-0.5 * ((g.gx - (w.e * p.width + p.lo)) / p.bw) * ((g.gx - (w.e * p.width + p.lo)) / p.bw)))
             / (p.n * p.bw * 2.5066282746310002) * p.n * (p.hi - p.lo) / 40, 4) AS density
FROM g, w, p GROUP BY g.point, g.gx, p.n, p.bw, p.hi, p.lo
""")
def q_density_curve_binned(spark, sf):
    """The density of the prices, mostly distinct."""
    curve = TX.density_curve_binned(_t(spark, sf, "lineitem"), "l_extendedprice", points=200, count_bins=40, decimals=4)
    return curve.withColumn("x", F.round("x", 4))
