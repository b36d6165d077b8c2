"""The star-schema analyses on invented records, checked against DuckDB SQL."""

import random

import duckdb
import pytest

from faultline.plans import error_star as ES
from faultline.sources.schemas import FLAT_RECORDS
from tools.parity import rows_of

SUBTYPES = {"syntax": ["misspelled keyword", "missing comma", "unbalanced parenthesis", "stray quote"],
            "schema": ["unknown column", "unknown table", "ambiguous column"],
            "logic": ["wrong join"], "construction": ["incomplete query"]}
EMOTIONS = ["anger", "calm", "joy", "neutral", "sad"]
QUERIES = ["SELECT a FROM t WHERE b = 1", "SELECT a, COUNT(*) FROM t GROUP BY a",
           "SELECT * FROM t JOIN u ON t.id = u.id", "SELECT a FROM t ORDER BY a",
           "SELECT DISTINCT a FROM t", "SELECT a FROM (SELECT a FROM t) s", "INSERT INTO t VALUES (1)",
           "UPDATE t SET a = 2", "SELECT a FROM t", "SELECT a FROM t GROUP BY a HAVING COUNT(*) > 2"]


def ladder(q):
    u = q.upper()
    for kw, label in [("GROUP BY", "GROUP BY"), ("HAVING", "HAVING"), ("JOIN", "JOIN"), ("ORDER BY", "ORDER BY"),
                      ("WHERE", "WHERE"), ("DISTINCT", "DISTINCT")]:
        if kw in u:
            return label
    if u.count("SELECT") >= 2:
        return "SUBQUERY"
    for kw in ("INSERT", "UPDATE", "DELETE"):
        if kw in u:
            return kw
    return "SELECT"


@pytest.fixture(scope="module")
def flat_rows():
    rnd = random.Random(5)
    out = []
    for i in range(420):
        typ = rnd.choice(["syntax", "syntax", "schema", "logic", "construction"])
        out.append((rnd.choice(QUERIES) + ("" if i % 7 else " "), typ, rnd.choice(SUBTYPES[typ]),
                    rnd.choice(EMOTIONS), f"Hint {i % 37}: check the clause.", f"Outcome {(i * 11) % 23}"))
    return out


@pytest.fixture(scope="module")
def star(spark, flat_rows):
    flat = spark.createDataFrame(flat_rows, FLAT_RECORDS).coalesce(1)
    tables = ES.prepare_error_star(flat)
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toPandas())
    return tables, con


def test_prepared_tables(star, flat_rows):
    tables, _ = star
    kept = [r for r in flat_rows if r[1] in ES.KEPT_TYPES]
    sub = sorted(tuple(r) for r in tables["Submission"].collect())
    assert [s[0] for s in sub] == list(range(1, len(kept) + 1))
    concepts = {r.concept_id: r.concept_name for r in tables["SQLConcept"].collect()}
    assert [concepts[s[4]] for s in sub] == [ladder(r[0]) for r in kept]
    assert [r.type_name for r in tables["ErrorType"].orderBy("error_type_id").collect()] == ["schema", "syntax"]
    outcomes = tables["LearningOutcome"].orderBy("outcome_id").collect()
    first_seen = list(dict.fromkeys(r[5] for r in kept))
    assert [o.outcome_text for o in outcomes] == first_seen


SQL = {
    "frequency_by_concept": """
        SELECT c.concept_name AS sql_concept, s.subtype_name AS error_subtype, t.type_name AS error_type,
               COUNT(*) AS frequency
        FROM Submission f, SQLConcept c, ErrorSubtype s, ErrorType t
        WHERE f.concept_id = c.concept_id AND f.subtype_id = s.subtype_id AND s.error_type_id = t.error_type_id
        GROUP BY 1, 2, 3""",
    "errors_per_subtype": """
        SELECT c.concept_name AS sql_concept, COUNT(*) AS total_errors,
               COUNT(DISTINCT f.subtype_id) AS distinct_subtypes,
               CAST(ROUND(CAST(COUNT(*) AS DECIMAL(18, 6)) / COUNT(DISTINCT f.subtype_id), 2) AS DOUBLE)
                 AS avg_errors_per_subtype
        FROM Submission f JOIN SQLConcept c USING (concept_id) GROUP BY 1""",
    "dominant_subtype": """
        WITH n AS (SELECT concept_id, subtype_id, COUNT(*) AS k FROM Submission GROUP BY 1, 2),
        m AS (SELECT concept_id, MAX(k) AS top, SUM(k) AS tot FROM n GROUP BY 1)
        SELECT c.concept_name, s.subtype_name AS dominant_subtype, n.k AS dominant_count,
               CAST(m.tot AS BIGINT) AS total_errors,
               CAST(ROUND(CAST(n.k AS DECIMAL(18, 6)) * 100 / m.tot, 1) AS DOUBLE) AS dominance_pct,
               CASE WHEN n.k * 100 > 40 * m.tot THEN 'High persistence' ELSE 'Distributed' END
                 AS persistence_label
        FROM n JOIN m ON n.concept_id = m.concept_id AND n.k = m.top
        JOIN SQLConcept c ON c.concept_id = n.concept_id JOIN ErrorSubtype s ON s.subtype_id = n.subtype_id""",
    "concept_difficulty": """
        SELECT c.concept_name, COUNT(*) AS total_errors, COUNT(DISTINCT f.subtype_id) AS subtype_diversity,
               COUNT_IF(t.type_name = 'syntax') AS syntax_errors, COUNT_IF(t.type_name = 'schema') AS schema_errors,
               RANK() OVER (ORDER BY COUNT(*) DESC, COUNT(DISTINCT f.subtype_id)) AS difficulty_rank
        FROM Submission f JOIN SQLConcept c USING (concept_id) JOIN ErrorSubtype s USING (subtype_id)
        JOIN ErrorType t USING (error_type_id) GROUP BY 1""",
    "emotion_by_subtype": """
        WITH n AS (SELECT s.subtype_name, e.emotion_name, COUNT(*) AS count
                   FROM Submission f JOIN ErrorSubtype s USING (subtype_id) JOIN Emotion e USING (emotion_id)
                   GROUP BY 1, 2)
        SELECT subtype_name, emotion_name, count,
               CAST(ROUND(CAST(count AS DECIMAL(18, 6)) * 100 / SUM(count) OVER (PARTITION BY subtype_name), 1)
                    AS DOUBLE) AS pct_within_subtype
        FROM n""",
    "schema_vs_syntax": """
        SELECT c.concept_name, COUNT_IF(t.type_name = 'syntax') AS syntax_count,
               COUNT_IF(t.type_name = 'schema') AS schema_count, COUNT(*) AS total,
               CAST(ROUND(CAST(COUNT_IF(t.type_name = 'schema') AS DECIMAL(18, 6)) * 100 / COUNT(*), 1) AS DOUBLE)
                 AS schema_pct
        FROM Submission f JOIN SQLConcept c USING (concept_id) JOIN ErrorSubtype s USING (subtype_id)
        JOIN ErrorType t USING (error_type_id) GROUP BY 1""",
    "top_error_subtypes": """
        SELECT s.subtype_name, t.type_name AS error_type, COUNT(*) AS frequency,
               RANK() OVER (ORDER BY COUNT(*) DESC) AS rnk
        FROM Submission f JOIN ErrorSubtype s USING (subtype_id) JOIN ErrorType t USING (error_type_id)
        GROUP BY 1, 2 ORDER BY frequency DESC, s.subtype_name, t.type_name LIMIT 4""",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_analysis_matches_sql(star, name):
    tables, con = star
    fn = getattr(ES, name)
    got = (fn(tables, 4) if name == "top_error_subtypes" else fn(tables)).toPandas()
    want = con.execute(SQL[name]).df()
    for c in want.columns:
        if str(want[c].dtype).startswith(("int", "Int")):
            want[c] = want[c].astype("int64")
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_difficulty_view_and_examples(spark, star):
    tables, con = star
    ES.concept_difficulty(tables)
    assert spark.table("v_concept_difficulty").count() == tables["SQLConcept"].count()
    got = {r.subtype_id: r.submission_id for r in ES.examples(tables).collect()}
    want = dict(con.execute("SELECT subtype_id, MIN(submission_id) FROM Submission GROUP BY 1").fetchall())
    assert got == want
    top = ES.top_patterns(tables, 3).collect()
    assert [r.frequency_rank for r in top] == [1, 2, 3]


def test_sql_surface(spark, star):
    tables, _ = star
    names = ES.register_sql(spark, tables)
    assert "Submission" in names and "GetTopErrorSubtypes" in names
    via_sql = rows_of(spark.sql("SELECT * FROM GetTopErrorSubtypes(4)").toPandas())
    via_api = rows_of(ES.top_error_subtypes(tables, 4).toPandas())
    assert via_sql == via_api
    assert spark.sql("SELECT COUNT(*) FROM v_concept_difficulty").first()[0] == tables["SQLConcept"].count()
    assert spark.sql("SELECT COUNT(*) FROM Submission").first()[0] == tables["Submission"].count()


def test_profile_records(spark, flat_rows):
    from collections import Counter

    flat = spark.createDataFrame(flat_rows, FLAT_RECORDS)
    prof = ES.profile_records(flat)
    assert prof["shape"].first()[:] == (len(flat_rows), 6)
    types = Counter(r[1] for r in flat_rows)
    assert {r[0]: r[1] for r in prof["error_types"].collect()} == dict(types)
    assert sum(r["count"] for r in prof["length_histogram"].collect()) == len(flat_rows)
    by_type = {r[0]: (r[1], r[2]) for r in prof["length_by_type"].collect()}
    for t, n in types.items():
        lens = [len(r[4]) for r in flat_rows if r[1] == t]
        assert by_type[t][0] == n and abs(by_type[t][1] - sum(lens) / n) < 1e-9
    pct = prof["type_by_emotion_pct"].collect()
    assert all(abs(sum(r[1:]) - 100) < 1e-9 for r in pct)
    assert prof["top_subtypes"].count() <= 10 and prof["nulls"].count() == 6


def test_generate_feedback_twice(spark, star):
    import datetime as dt

    import pandas as pd

    from faultline.session import scratch_path

    tables, con = star

    def service(prompts: pd.Series) -> pd.Series:
        return "  Look at the " + prompts.str.extract(r'concept "([^"]+)"')[0] + " clause again.\n"

    v1, v2 = scratch_path(spark, "fb1"), scratch_path(spark, "fb2")
    r1 = ES.generate_feedback(tables, service, v1, top_n=3, model_name="pure", now=dt.datetime(2024, 5, 1)).collect()
    assert [r.frequency_rank for r in r1] == [1, 2, 3]
    assert all(r.preview.startswith("Look at the ") for r in r1)
    top = con.execute("""SELECT s.subtype_name, COUNT(*) AS n FROM Submission f JOIN ErrorSubtype s USING (subtype_id)
                         GROUP BY 1 ORDER BY n DESC, MIN(f.subtype_id) LIMIT 3""").fetchall()
    assert [(r.subtype_name, r.error_frequency) for r in r1] == [(a, b) for a, b in top]
    stored = spark.read.parquet(v1)
    assert set(stored.columns) == {"feedback_id", "subtype_id", "example_submission_id", "model_name", "prompt_text",
                                   "generated_feedback", "frequency_rank", "error_frequency", "generated_at"}
    first = con.execute("SELECT subtype_id, MIN(submission_id) FROM Submission GROUP BY 1").fetchall()
    ex = dict(first)
    assert all(ex[r.subtype_id] == r.example_submission_id for r in stored.collect())
    r2 = ES.generate_feedback(tables, service, v2, table_path=v1, top_n=3, model_name="pure").collect()
    assert [tuple(r) for r in r2] == [tuple(r) for r in r1]
    ids1 = {r.subtype_id: r.feedback_id for r in stored.collect()}
    ids2 = {r.subtype_id: r.feedback_id for r in spark.read.parquet(v2).collect()}
    assert ids1 == ids2


def test_csv_to_star_end_to_end(spark, flat_rows):
    from faultline.session import scratch_path
    from faultline.sources.tables import read_csv, write_csv

    rows_ = [(q + "\n-- note, \"quoted\"", t, s, e, f, o) for q, t, s, e, f, o in flat_rows[:120]]
    path = scratch_path(spark, "flat_csv")
    write_csv(spark.createDataFrame(rows_, FLAT_RECORDS).coalesce(1), path)
    tables = ES.prepare_error_star(read_csv(spark, path, FLAT_RECORDS))
    kept = [r for r in rows_ if r[1] in ES.KEPT_TYPES]
    sub = sorted(tables["Submission"].collect())
    assert [s.submission_id for s in sub] == list(range(1, len(kept) + 1))
    assert [s.query_text for s in sub] == [r[0] for r in kept]
    concepts = {r.concept_id: r.concept_name for r in tables["SQLConcept"].collect()}
    assert [concepts[s.concept_id] for s in sub] == [ladder(r[0]) for r in kept]
    freq = ES.frequency_by_concept(tables).collect()
    assert sum(r.frequency for r in freq) == len(kept)
