"""Analyses on invented rows, checked against plain-Python brute force."""

import random
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from faultline.operators import analysis as A
from faultline.operators.joins import Dim
from tests.conftest import rows


def pct(c, t, k=1, scale=100):
    return float((Decimal(c * scale) / Decimal(t)).quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP))


@pytest.fixture(scope="module")
def star(spark):
    rnd = random.Random(11)
    types = [(1, "schema"), (2, "syntax")]
    subtypes = [(i, f"subtype {i}", 1 + i % 2) for i in range(1, 9)]
    concepts = [(i, c) for i, c in enumerate(["WHERE", "JOIN", "GROUP BY", "HAVING", "UPDATE"], start=1)]
    facts = []
    for sid in range(1, 401):
        concept = rnd.choice([1, 1, 1, 2, 2, 3, 4, 5])
        facts.append((sid, rnd.randint(1, 8), concept))
    # ties at the top of concept 5, a one-row concept 4
    facts = [f for f in facts if f[2] not in (4, 5)]
    facts += [(1001, 3, 5), (1002, 4, 5), (1003, 3, 5), (1004, 4, 5), (1005, 1, 5), (1006, 2, 4)]
    return {
        "type": spark.createDataFrame(types, "error_type_id int, type_name string"),
        "subtype": spark.createDataFrame(subtypes, "subtype_id int, subtype_name string, error_type_id int"),
        "concept": spark.createDataFrame(concepts, "concept_id int, concept_name string"),
        "fact": spark.createDataFrame(facts, "submission_id int, subtype_id int, concept_id int"),
        "py": dict(types=dict(types), subtypes={s[0]: s for s in subtypes}, concepts=dict(concepts), facts=facts),
    }


def _dims(star):
    sub = star["subtype"].join(star["type"], "error_type_id").select("subtype_id", "subtype_name", "type_name")
    return [Dim(star["concept"], on="concept_id", columns=["concept_name"]),
            Dim(sub, on="subtype_id", columns=["subtype_name", "type_name"])]


def _named(py):
    for sid, st, c in py["facts"]:
        s = py["subtypes"][st]
        yield sid, py["concepts"][c], s[1], py["types"][s[2]]


def test_frequency_by_keys(star):
    got = rows(A.frequency_by_keys(star["fact"], ["concept_name", "subtype_name", "type_name"], _dims(star)))
    want = Counter((c, s, t) for _, c, s, t in _named(star["py"]))
    assert {g[:3]: g[3] for g in got} == dict(want)
    # concept ascending, frequency descending
    assert got == sorted(got, key=lambda r: (r[0], -r[3], r[1], r[2]))


def test_ratio_total_to_distinct(star):
    got = {r[0]: r[1:] for r in rows(A.ratio_total_to_distinct(star["fact"], "concept_name", "subtype_id",
                                                                  [_dims(star)[0]]))}
    by = defaultdict(list)
    for sid, st, c in star["py"]["facts"]:
        by[star["py"]["concepts"][c]].append(st)
    for c, sts in by.items():
        assert got[c] == (len(sts), len(set(sts)), pct(len(sts), len(set(sts)), 2, scale=1))


def test_dominant_member_keeps_ties_and_strict_threshold(star):
    res = A.dominant_member(star["fact"], "concept_name", "subtype_name", threshold=40, dims=_dims(star))
    got = rows(res)
    top5 = sorted((r[1], r[2], r[3], r[4], r[5]) for r in got if r[0] == "UPDATE")
    # 2 + 2 of 5 rows: two members tied at 40.0 %, which is not above 40.
    assert top5 == [("subtype 3", 2, 5, 40.0, "Distributed"), ("subtype 4", 2, 5, 40.0, "Distributed")]
    having = [r for r in got if r[0] == "HAVING"]
    assert having == [("HAVING", "subtype 2", 1, 1, 100.0, "High persistence")]
    counts = Counter((c, s) for _, c, s, _ in _named(star["py"]))
    for c in {k[0] for k in counts}:
        best = max(v for (cc, _), v in counts.items() if cc == c)
        want = {s for (cc, s), v in counts.items() if cc == c and v == best}
        assert {r[1] for r in got if r[0] == c} == want


def test_difficulty_rank(star):
    res = A.difficulty_rank(star["fact"], "concept_name", "subtype_id", "type_name",
                            {"syntax": "syntax_errors", "schema": "schema_errors"}, _dims(star), view="v_diff")
    got = rows(res)
    stats = {}
    for sid, c, s, t in _named(star["py"]):
        e = stats.setdefault(c, [0, set(), 0, 0])
        e[0] += 1
        e[1].add(s)
        e[2] += t == "syntax"
        e[3] += t == "schema"
    keys = {c: (-e[0], len(e[1])) for c, e in stats.items()}
    for r in got:
        c, total, div, syn, sch, rank = r
        assert (total, div, syn, sch) == (stats[c][0], len(stats[c][1]), stats[c][2], stats[c][3])
        assert rank == 1 + sum(1 for k in keys.values() if k < keys[c])
    assert [r[-1] for r in got] == sorted(r[-1] for r in got)
    assert star["fact"].sparkSession.table("v_diff").count() == len(got)


def test_share_within_group_sums_to_about_100(star):
    res = A.share_within_group(star["fact"], "subtype_name", "concept_name", _dims(star))
    per = defaultdict(float)
    for s, c, n, p in rows(res):
        per[s] += p
    for s, total in per.items():
        assert abs(total - 100) < 0.5 * 5


def test_conditional_split(star):
    res = A.conditional_split(star["fact"], "concept_name", "type_name", "syntax", "schema", _dims(star))
    for c, syn, sch, total, p in rows(res):
        assert syn + sch == total
        assert p == pct(sch, total)


def test_top_n_ranked_tie_break_and_rank(spark):
    df = spark.createDataFrame([(k,) for k, n in [("a", 3), ("b", 3), ("c", 2), ("d", 2), ("e", 1)]
                                for _ in range(n)], "k string")
    assert rows(A.top_n_ranked(df, "k", 3)) == [("a", 3, 1), ("b", 3, 1), ("c", 2, 3)]
    assert rows(A.top_n_ranked(df, "k", 3, method="row_number")) == [("a", 3, 1), ("b", 3, 2), ("c", 2, 3)]


def test_value_counts_and_percent_of_total(spark):
    df = spark.createDataFrame([("x",)] * 3 + [("y",)] * 3 + [("z",)] * 2, "v string")
    assert rows(A.value_counts(df, "v")) == [("x", 3), ("y", 3), ("z", 2)]
    assert rows(A.value_counts(df, "v", n=1)) == [("x", 3)]
    assert rows(A.percent_of_total(df, "v")) == [("x", 3, 37.5), ("y", 3, 37.5), ("z", 2, 25.0)]


def test_crosstab_fills_missing_cells_with_zero(spark):
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 1), ("b", 0), ("b", None), (None, 1)], "r string, c int")
    got = rows(A.crosstab_row_pct(df, "r", "c", [0, 1], names=["c0", "c1"]))
    assert got == [("a", 1 / 3 * 100, 2 / 3 * 100), ("b", 100.0, 0.0)]


def test_crosstab_accounts_for_values_not_listed(spark):
    df = spark.createDataFrame([("a", 0), ("a", 7), ("a", 9), ("a", 0)], "r string, c int")
    assert rows(A.crosstab_row_pct(df, "r", "c", [0], names=["c0"], other="rest")) == [("a", 50.0, 50.0)]
    with pytest.raises(Exception, match="value not listed"):
        A.crosstab_row_pct(df, "r", "c", [0], names=["c0"]).collect()


def test_null_is_no_value_unless_asked_for(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 7.0), (None, 9.0)], "k string, x double")
    assert rows(A.value_counts(df, "k")) == [("a", 2)]
    assert rows(A.value_counts(df, "k", dropna=False)) == [(None, 3), ("a", 2)]
    assert rows(A.percent_of_total(df, "k")) == [("a", 2, 100.0)]
    assert rows(A.group_count_mean(df, "k", "x", "x")) == [("a", 2, 2.0)]
    assert rows(A.group_count_mean(df, "k", "x", "x", dropna=False)) == [(None, 3, 7.0), ("a", 2, 2.0)]


def test_difficulty_view_is_live(spark):
    from faultline.session import scratch_path
    path = scratch_path(spark, "live")
    spark.createDataFrame([("a", 1, "x"), ("b", 1, "x")], "k string, m int, c string").write.parquet(path)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW live_fact AS SELECT * FROM parquet.`{path}`")
    A.difficulty_rank(spark.table("live_fact"), "k", "m", "c", {"x": "xs"}, view="live_rank")
    assert spark.table("live_rank").orderBy("difficulty_rank", "k").first()["k"] == "a"
    plan = spark.table("live_rank")._jdf.queryExecution().optimizedPlan().toString()
    assert "ExistingRDD" not in plan and "LogicalRDD" not in plan


def test_top_n_function_does_not_gather_all_groups(spark):
    df = spark.range(9000).selectExpr("id % 6000 AS k")
    df.createOrReplaceTempView("many_groups")
    A.register_top_n_function(spark, "top_many", "many_groups", ["k"], ["BIGINT"])
    got = spark.sql("SELECT * FROM top_many(5000) ORDER BY frequency DESC, k")
    want = [(i, 2, 1) for i in range(3000)] + [(i, 1, 3001) for i in range(3000, 5000)]
    assert [tuple(r) for r in got.collect()] == want


def test_group_count_mean_counts_non_null(spark):
    df = spark.createDataFrame([("a", "xx"), ("a", None), ("b", "xyz")], "g string, s string")
    got = rows(A.group_count_mean(df, "g", "s", F.length("s")))
    assert got == [("a", 1, 2.0), ("b", 1, 3.0)]


def test_sql_table_function_matches_operator(spark):
    df = spark.createDataFrame([(k,) for k, n in [(1, 3), (2, 3), (3, 2), (4, 2), (5, 1)] for _ in range(n)],
                               "k int")
    df.createOrReplaceTempView("t_keys")
    A.register_top_n_function(spark, "top_keys", "t_keys", ["k"], ["INT"])
    got = rows(spark.sql("SELECT * FROM top_keys(3) ORDER BY frequency DESC, k"))
    assert got == rows(A.top_n_ranked(df, "k", 3)) == [(1, 3, 1), (2, 3, 1), (3, 2, 3)]


def test_collation_groups_case_accent_and_trailing_space(spark):
    from faultline.functions.text import collate_columns
    df = spark.createDataFrame([("Syntax",), ("syntax ",), ("sýntax",), ("schema",)], "t string")
    got = sorted(r[1] for r in A.value_counts(collate_columns(df, "t"), "t").collect())
    assert got == [1, 3]
    assert A.value_counts(df, "t").count() == 4  # default: binary comparison, case matters


def test_null_group_is_kept_like_group_by(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), ("g", "b")], "g string, m string")
    dom = rows(A.dominant_member(df, "g", "m", 50))
    assert (None, "a", 2, 3, 66.7, "High persistence") in dom and len(dom) == 2
    share = rows(A.share_within_group(df, "g", "m"))
    assert sorted(share, key=str) == sorted([(None, "a", 2, 66.7), (None, "b", 1, 33.3), ("g", "b", 1, 100.0)],
                                            key=str)


def test_approximate_distinct_is_opt_in(spark):
    df = spark.createDataFrame([(k % 3, k) for k in range(3000)], "g int, v int")
    exact = {r[0]: r[2] for r in rows(A.ratio_total_to_distinct(df, "g", "v"))}
    approx = {r[0]: r[2] for r in rows(A.ratio_total_to_distinct(df, "g", "v", approx_rsd=0.02))}
    assert exact == {0: 1000, 1: 1000, 2: 1000}
    assert all(abs(approx[g] - 1000) <= 80 for g in approx)


def test_ranks_from_distinct_counts_match_rank(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    per_key = spark.range(500).selectExpr("id AS k", "id % 7 + 1 AS total", "id % 3 + 1 AS diversity")
    order = [F.col("total").desc(), F.col("diversity").asc()]
    want = {r["k"]: r["r"] for r in per_key.withColumn("r", F.rank().over(Window.orderBy(*order))).collect()}
    got = A._rank_from_counts(per_key, "total", "diversity", "r")
    assert {r["k"]: r["r"] for r in got.collect()} == want
    assert A._rank_from_counts(per_key.limit(0), "total", "diversity", "r").count() == 0


def test_difficulty_view_gathers_no_keys_in_one_task(spark):
    fact = spark.range(3000).selectExpr("id % 40 AS k", "id % 11 AS m", "IF(id % 2 = 0, 'a', 'b') AS c")
    ranked = A.difficulty_rank(fact, "k", "m", "c", {"a": "n_a"}, view="v_ranked")
    assert sorted(map(tuple, spark.table("v_ranked").collect())) == sorted(map(tuple, ranked.collect()))
    plan = spark.table("v_ranked")._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("windowspecdefinition(total"):]
    assert plan.count("Window") == 2 and "Aggregate [total" in window  # windows over distinct counts, not over keys


def test_united_sketches_are_the_sketch_of_all(spark):
    df = spark.range(20000).selectExpr("id % 3 AS k", "CAST(id * 7 % 5000 AS string) AS m", "id % 5 AS load")
    whole = A.ratio_from_sketches(A.distinct_sketches(df, "k", "m"), "k")
    parts = A.distinct_sketches(df.filter("load < 2"), "k", "m").unionAll(A.distinct_sketches(df.filter("load >= 2"), "k", "m"))
    united = A.ratio_from_sketches(A.united_sketches(parts, "k"), "k")
    got = sorted(map(tuple, united.collect()))
    assert got == sorted(map(tuple, whole.collect()))
    assert all(abs(d - 5000) <= 5000 * 0.05 for _, _, d, _ in got) and sum(t for _, t, _, _ in got) == 20000


def test_top_n_function_cuts_a_large_tie(spark):
    spark.range(4000).selectExpr("id AS k").unionAll(spark.createDataFrame([(5,), (5,), (9,)], "k long")).createOrReplaceTempView("ties")
    fn = A.register_top_n_function(spark, "top_ties", "ties", ["k"], ["BIGINT"])
    got = sorted(map(tuple, spark.sql(f"SELECT * FROM {fn}(6)").collect()), key=lambda r: (-r[1], r[0]))
    assert got == [(5, 3, 1), (9, 2, 2), (0, 1, 3), (1, 1, 3), (2, 1, 3), (3, 1, 3)]


def test_value_counts_computes_a_key_once_a_row(spark):
    from faultline.operators.prepare import classify_by_keywords

    df = spark.createDataFrame([("select 1",), (None,), ("update x",)], "t string")
    counts = A.value_counts(classify_by_keywords(df, "t"), "concept")
    assert sorted(map(tuple, counts.collect())) == [("SELECT", 1), ("UPDATE", 1)]
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN Contains") == 1
