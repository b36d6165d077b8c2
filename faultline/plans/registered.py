"""The reference's analyses bound to the driver's test tables.

``lineitem -> supplier -> nation -> region`` plus ``lineitem -> part``
(fact; subtype = nation, type = region, concept = part type); *text* is
``documents.text``; categories are ``lang``, ``source`` and ``event_type``.
Every query reads whole tables; ``ORACLE_SQL`` holds an independent DuckDB
statement with the same column names for each.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from ..functions.text import escape_literal, left, preview, render_template
from ..operators import analysis as A
from ..operators import feedback as FB
from ..operators import prepare as P
from ..operators import quality as Q
from ..operators import text as TX
from ..operators.joins import Dim
from ..operators.ranking import sequence_ids
from ..session import scratch_path
from ..sources import tables as S


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query under ``name`` with its DuckDB oracle statement."""
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return S.table(spark, sf, name)


def supplier_geo(spark: SparkSession, sf: str) -> DataFrame:
    """supplier -> nation -> region resolved to (s_suppkey, n_name, r_name).

    Plain joins: nation and region are small files Spark broadcasts by its
    own size estimate; the composite is counted once by the fact's
    ``attach`` before any broadcast decision of ours."""
    region = _t(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    nation = (_t(spark, sf, "nation").join(region, "n_regionkey")
              .select(F.col("n_nationkey").alias("s_nationkey"), "n_name", "r_name"))
    return _t(spark, sf, "supplier").join(nation, "s_nationkey").select("s_suppkey", "n_name", "r_name")


def snowflake_dims(spark: SparkSession, sf: str, part_cols=("p_type",), geo_cols=("n_name", "r_name")):
    """Dimensions of lineitem: part attributes and supplier geography."""
    return [Dim(_t(spark, sf, "part"), on="l_partkey", key="p_partkey", columns=list(part_cols)),
            Dim(supplier_geo(spark, sf), on="l_suppkey", key="s_suppkey", columns=list(geo_cols))]


_SNOWFLAKE_FROM = """
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def _pct_sql(c: str, t: str, decimals: int = 1) -> str:
    p = 10 ** decimals
    return f"((2 * {p * 100} * ({c}) + ({t})) // (2 * ({t}))) / {p}"


# --------------------------------------------------------------------- analyses

@register("frequency_by_keys", f"""
SELECT p.p_type, n.n_name, r.r_name, COUNT(*) AS frequency
{_SNOWFLAKE_FROM}
GROUP BY p.p_type, n.n_name, r.r_name
ORDER BY p.p_type, frequency DESC, n.n_name, r.r_name
""")
def q_frequency_by_keys(spark, sf):
    return A.frequency_by_keys(_t(spark, sf, "lineitem"), ["p_type", "n_name", "r_name"],
                               dims=snowflake_dims(spark, sf))


@register("frequency_by_keys_eager", ORACLE_SQL["frequency_by_keys"])
def q_frequency_by_keys_eager(spark, sf):
    """The same frequencies on the path large dimensions take: the fact is
    pre-aggregated by its foreign keys, then joined with shuffles."""
    return A.frequency_by_keys(_t(spark, sf, "lineitem"), ["p_type", "n_name", "r_name"],
                               dims=snowflake_dims(spark, sf), broadcast_max_rows=0)


@register("ratio_total_to_distinct", f"""
SELECT p.p_type, COUNT(*) AS total, COUNT(DISTINCT p.p_brand) AS distinct_count,
       ((2 * 100 * COUNT(*) + COUNT(DISTINCT p.p_brand)) // (2 * COUNT(DISTINCT p.p_brand))) / 100 AS ratio
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_type
ORDER BY ratio DESC, p.p_type
""")
def q_ratio_total_to_distinct(spark, sf):
    return A.ratio_total_to_distinct(
        _t(spark, sf, "lineitem"), "p_type", "p_brand",
        dims=[Dim(_t(spark, sf, "part"), on="l_partkey", key="p_partkey", columns=["p_type", "p_brand"])])


@register("dominant_member", f"""
WITH c AS (SELECT user_id, event_type, COUNT(*) AS cnt FROM events GROUP BY user_id, event_type),
r AS (SELECT user_id, event_type, cnt,
             CAST(SUM(cnt) OVER (PARTITION BY user_id) AS BIGINT) AS total,
             RANK() OVER (PARTITION BY user_id ORDER BY cnt DESC) AS rnk
      FROM c)
SELECT user_id, event_type, cnt AS dominant_count, total,
       {_pct_sql('cnt', 'total')} AS dominance_pct,
       CASE WHEN cnt * 100 > 25 * total THEN 'High persistence' ELSE 'Distributed' END AS label
FROM r WHERE rnk = 1
""")
def q_dominant_member(spark, sf):
    return A.dominant_member(_t(spark, sf, "events"), "user_id", "event_type", threshold=25)


@register("difficulty_rank", f"""
SELECT p.p_brand, COUNT(*) AS total, COUNT(DISTINCT l.l_suppkey) AS diversity,
       CAST(SUM(CASE WHEN r.r_name = 'ASIA' THEN 1 ELSE 0 END) AS BIGINT) AS asia_count,
       CAST(SUM(CASE WHEN r.r_name = 'EUROPE' THEN 1 ELSE 0 END) AS BIGINT) AS europe_count,
       RANK() OVER (ORDER BY COUNT(*) DESC, COUNT(DISTINCT l.l_suppkey) ASC) AS difficulty_rank
{_SNOWFLAKE_FROM}
GROUP BY p.p_brand
ORDER BY difficulty_rank, p.p_brand
""")
def q_difficulty_rank(spark, sf):
    return A.difficulty_rank(_t(spark, sf, "lineitem"), "p_brand", "l_suppkey", "r_name",
                             {"ASIA": "asia_count", "EUROPE": "europe_count"},
                             dims=snowflake_dims(spark, sf, part_cols=("p_brand",), geo_cols=("r_name",)),
                             view="v_brand_difficulty")


@register("share_within_group", f"""
WITH c AS (SELECT lang, source, COUNT(*) AS cnt FROM documents GROUP BY lang, source),
t AS (SELECT lang, CAST(SUM(cnt) AS BIGINT) AS tot FROM c GROUP BY lang)
SELECT c.lang, c.source, c.cnt AS count, {_pct_sql('c.cnt', 't.tot')} AS pct_within_group
FROM c JOIN t ON c.lang = t.lang
ORDER BY c.lang, count DESC, c.source
""")
def q_share_within_group(spark, sf):
    return A.share_within_group(_t(spark, sf, "documents"), "lang", "source")


@register("conditional_split", f"""
SELECT o_orderpriority,
       CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS f_count,
       CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS o_count,
       COUNT(*) AS total,
       {_pct_sql("SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)", 'COUNT(*)')} AS o_pct
FROM orders GROUP BY o_orderpriority
ORDER BY o_pct DESC, o_orderpriority
""")
def q_conditional_split(spark, sf):
    return A.conditional_split(_t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "F", "O",
                               first_name="f_count", second_name="o_count", pct_name="o_pct")


@register("top_n_ranked", """
SELECT c_nationkey, COUNT(*) AS frequency, RANK() OVER (ORDER BY COUNT(*) DESC) AS rnk
FROM customer GROUP BY c_nationkey
ORDER BY frequency DESC, c_nationkey LIMIT 10
""")
def q_top_n_ranked(spark, sf):
    return A.top_n_ranked(_t(spark, sf, "customer"), "c_nationkey", 10)


@register("top_n_function", """
SELECT c_nationkey, COUNT(*) AS frequency, RANK() OVER (ORDER BY COUNT(*) DESC) AS rnk
FROM customer GROUP BY c_nationkey
ORDER BY frequency DESC, c_nationkey LIMIT 10
""")
def q_top_n_function(spark, sf):
    _t(spark, sf, "customer").createOrReplaceTempView("fl_customer")
    fn = A.register_top_n_function(spark, "fl_top_nations", "fl_customer", ["c_nationkey"], ["INT"])
    return spark.sql(f"SELECT * FROM {fn}(10) ORDER BY frequency DESC, c_nationkey")


# Keyword ladder used on the test documents (priority order).
DOC_RULES = (
    ("LICENSE", "license"),
    ("TOKEN", "secret"),
    ("@", "contact"),
    (" AND ", "english"),
    (" DER ", "german"),
    ("THE ", "prose", 2),
)
DOC_DEFAULT = "other"

_DOC_CASE = """CASE
  WHEN contains(upper(text), 'LICENSE') THEN 'license'
  WHEN contains(upper(text), 'TOKEN') THEN 'secret'
  WHEN contains(upper(text), '@') THEN 'contact'
  WHEN contains(upper(text), ' AND ') THEN 'english'
  WHEN contains(upper(text), ' DER ') THEN 'german'
  WHEN (length(upper(text)) - length(replace(upper(text), 'THE ', ''))) // 4 >= 2 THEN 'prose'
  ELSE 'other' END"""


@register("classify_by_keywords", f"SELECT doc_id, {_DOC_CASE} AS concept FROM documents")
def q_classify_by_keywords(spark, sf):
    docs = _t(spark, sf, "documents")
    return P.classify_by_keywords(docs, "text", DOC_RULES, DOC_DEFAULT).select("doc_id", "concept")


@register("value_counts", f"""
SELECT concept, COUNT(*) AS count FROM (SELECT {_DOC_CASE} AS concept FROM documents) WHERE concept IS NOT NULL
GROUP BY concept ORDER BY count DESC, concept
""")
def q_value_counts(spark, sf):
    return A.value_counts(q_classify_by_keywords(spark, sf), "concept")


@register("top_values", """
SELECT source, COUNT(*) AS count FROM documents WHERE source IS NOT NULL GROUP BY source
ORDER BY count DESC, source LIMIT 10
""")
def q_top_values(spark, sf):
    """The ten most frequent sources (``value_counts().head(10)``), ties by value."""
    return A.value_counts(_t(spark, sf, "documents"), "source", n=10)


@register("percent_of_total", f"""
WITH c AS (SELECT lang, COUNT(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang),
t AS (SELECT CAST(SUM(count) AS BIGINT) AS tot FROM c)
SELECT c.lang, c.count, {_pct_sql('c.count', 't.tot')} AS pct FROM c, t
ORDER BY c.count DESC, c.lang
""")
def q_percent_of_total(spark, sf):
    return A.percent_of_total(_t(spark, sf, "documents"), "lang")


@register("filter_categories", """
SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'purchase')
""")
def q_filter_categories(spark, sf):
    return P.filter_categories(_t(spark, sf, "events"), "event_type", ["error", "purchase"]) \
        .select("event_id", "event_type")


@register("first_example_per_group", """
SELECT d.lang, d.doc_id, d.source
FROM documents d JOIN (SELECT lang, MIN(doc_id) AS doc_id FROM documents GROUP BY lang) m
  ON d.lang = m.lang AND d.doc_id = m.doc_id
""")
def q_first_example_per_group(spark, sf):
    return FB.first_example_per_group(_t(spark, sf, "documents"), "lang", "doc_id", ["source"])


@register("crosstab_row_pct", """
SELECT d.lang,
       CAST(COUNT_IF(l.quality = 0) AS DOUBLE) / COUNT(*) * CAST(100.0 AS DOUBLE) AS q0,
       CAST(COUNT_IF(l.quality = 1) AS DOUBLE) / COUNT(*) * CAST(100.0 AS DOUBLE) AS q1
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE d.lang IS NOT NULL AND l.quality IS NOT NULL
GROUP BY d.lang ORDER BY d.lang
""")
def q_crosstab_row_pct(spark, sf):
    joined = _t(spark, sf, "documents").select("doc_id", "lang").join(
        _t(spark, sf, "labels").select("doc_id", "quality"), on="doc_id", how="inner")
    return A.crosstab_row_pct(joined, "lang", "quality", [0, 1], names=["q0", "q1"])


@register("group_count_mean", """
SELECT lang, COUNT(text) AS count, AVG(length(text)) AS mean FROM documents WHERE lang IS NOT NULL
GROUP BY lang ORDER BY lang
""")
def q_group_count_mean(spark, sf):
    return A.group_count_mean(_t(spark, sf, "documents"), "lang", "text", F.length("text"))


# ------------------------------------------------------------------------ text

_WORDS = r"""(SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents)"""


@register("top_words", f"""
SELECT word, COUNT(*) AS n FROM {_WORDS} WHERE word <> ''
GROUP BY word ORDER BY n DESC, word LIMIT 20
""")
def q_top_words(spark, sf):
    return TX.top_words(_t(spark, sf, "documents"), "text", 20)


@register("word_counts", f"""
SELECT word, COUNT(*) AS n FROM {_WORDS} WHERE word <> '' GROUP BY word
""")
def q_word_counts(spark, sf):
    """Every token of every document with its count (the whole vocabulary)."""
    return TX.word_counts(_t(spark, sf, "documents"), "text")


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in sorted(values))


@register("word_weights", rf"""
WITH w AS (SELECT regexp_replace(unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}\p{{M}}_][\p{{L}}\p{{N}}\p{{M}}_'']+')),
                                 '''s$', '') AS word FROM documents),
a AS (SELECT word, COUNT(*) AS n FROM w WHERE word <> '' AND NOT regexp_full_match(word, '\p{{Nd}}+')
        AND word NOT IN ({_sql_list(TX.STOPWORDS)}) GROUP BY word),
p AS (SELECT a.word, a.n, s.word AS single FROM a LEFT JOIN a s
      ON a.word LIKE '%s' AND a.word NOT LIKE '%ss' AND length(a.word) > 2 AND s.word = left(a.word, -1)),
c AS (SELECT COALESCE(single, word) AS word, CAST(SUM(n) AS BIGINT) AS n FROM p GROUP BY ALL)
SELECT word, n, n / (SELECT MAX(n) FROM c) AS weight FROM c ORDER BY n DESC, word LIMIT 200
""")
def q_word_weights(spark, sf):
    return TX.word_weights(_t(spark, sf, "documents"), "text", 200)


# Words in their order, the pairs of neighbours, their counts with plurals met, and the pairs' log-likelihood ratios.
_COLLOCATIONS_SQL = rf"""
WITH l AS (SELECT row_number() OVER () AS d, list_filter(list_transform(
             regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}\p{{M}}_][\p{{L}}\p{{N}}\p{{M}}_'']+'),
             lambda w: regexp_replace(w, '''s$', '')), lambda w: NOT regexp_full_match(w, '\p{{Nd}}+')) AS ws FROM documents),
o AS (SELECT d, i, ws[i] AS w FROM (SELECT d, ws, unnest(range(1, len(ws) + 1)) AS i FROM l)),
st AS (SELECT unnest([{_sql_list(TX.STOPWORDS)}]) AS w),
a AS (SELECT w, COUNT(*) AS n FROM o WHERE w NOT IN (SELECT w FROM st) GROUP BY w),
fm AS (SELECT a.w, a.n, COALESCE(s.w, a.w) AS form FROM a LEFT JOIN a s
       ON a.w LIKE '%s' AND a.w NOT LIKE '%ss' AND length(a.w) > 2 AND s.w = left(a.w, -1)),
c AS (SELECT form AS word, CAST(SUM(n) AS BIGINT) AS n FROM fm GROUP BY form),
p1 AS (SELECT x.w AS a, y.w AS b, COUNT(*) AS n FROM o x JOIN o y ON x.d = y.d AND y.i = x.i + 1
       WHERE x.w NOT IN (SELECT w FROM st) AND y.w NOT IN (SELECT w FROM st) GROUP BY ALL),
p2 AS (SELECT p.a, COALESCE(s.b, p.b) AS b, CAST(SUM(p.n) AS BIGINT) AS n FROM p1 p LEFT JOIN p1 s
       ON p.b LIKE '%s' AND p.b NOT LIKE '%ss' AND length(p.b) > 2 AND s.a = p.a AND s.b = left(p.b, -1) GROUP BY ALL),
k AS (SELECT p2.*, f1.form AS w1, f2.form AS w2, c1.n::DOUBLE AS c1, c2.n::DOUBLE AS c2, (SELECT SUM(n) FROM c)::DOUBLE AS t
      FROM p2 JOIN fm f1 ON f1.w = p2.a JOIN fm f2 ON f2.w = p2.b JOIN c c1 ON c1.word = f1.form JOIN c c2 ON c2.word = f2.form),
q AS (SELECT *, c2 - n AS r, t - c1 AS e, n / c1 AS s1, (c2 - n) / (t - c1) AS s2, c2 / t AS s0 FROM k WHERE t > c1 AND t > c2),
sc AS (SELECT *, 2 * (n * ln(greatest(s1, 1e-10)) + (c1 - n) * ln(greatest(1 - s1, 1e-10))
                      + r * ln(greatest(s2, 1e-10)) + (e - r) * ln(greatest(1 - s2, 1e-10))
                      - n * ln(greatest(s0, 1e-10)) - (c1 - n) * ln(greatest(1 - s0, 1e-10))
                      - r * ln(greatest(s0, 1e-10)) - (e - r) * ln(greatest(1 - s0, 1e-10))) AS score FROM q),
co AS (SELECT a || ' ' || b AS pair, n, score, w1, w2 FROM sc WHERE score > 30)
"""


@register("word_collocations", _COLLOCATIONS_SQL + "SELECT pair, n, ROUND(score, 4) AS score FROM co")
def q_word_collocations(spark, sf):
    """Neighbouring words that belong together."""
    found = TX.collocations(_t(spark, sf, "documents"), "text")
    return found.select("pair", "n", F.round("score", 4).alias("score"))


@register("word_pair_weights", _COLLOCATIONS_SQL + """,
tk AS (SELECT w, SUM(n) AS n FROM (SELECT w1 AS w, n FROM co UNION ALL SELECT w2, n FROM co) GROUP BY w),
al AS (SELECT word, CAST(c.n - COALESCE(tk.n, 0) AS BIGINT) AS n FROM c LEFT JOIN tk ON tk.w = c.word
       WHERE c.n > COALESCE(tk.n, 0) UNION ALL SELECT pair, n FROM co)
SELECT word, n, n / (SELECT MAX(n) FROM al) AS weight FROM al ORDER BY n DESC, word LIMIT 200
""")
def q_word_pair_weights(spark, sf):
    """The word cloud's words and pairs."""
    return TX.word_weights(_t(spark, sf, "documents"), "text", 200, pairs=True)


@register("histogram_equal_width", """
WITH v AS (SELECT CAST(length(text) AS BIGINT) AS x FROM documents WHERE text IS NOT NULL),
s AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v),
b AS (SELECT CASE WHEN s.hi = s.lo THEN 0 ELSE LEAST((v.x - s.lo) * 40 // (s.hi - s.lo), 39) END AS bin
      FROM v, s),
c AS (SELECT bin, COUNT(*) AS cnt FROM b GROUP BY bin)
SELECT g.range AS bin, s.lo + g.range * (s.hi - s.lo) / 40 AS bin_lo,
       s.lo + (g.range + 1) * (s.hi - s.lo) / 40 AS bin_hi, COALESCE(c.cnt, 0) AS count
FROM range(40) g CROSS JOIN s LEFT JOIN c ON c.bin = g.range
ORDER BY bin
""")
def q_histogram_equal_width(spark, sf):
    return TX.histogram_equal_width(_t(spark, sf, "documents"), F.length("text"), 40)


@register("density_curve", """
WITH v AS (SELECT CAST(length(text) AS DOUBLE) AS x FROM documents WHERE text IS NOT NULL),
s AS (SELECT COUNT(*) AS n, MIN(x) AS lo, MAX(x) AS hi, STDDEV_SAMP(x) AS sd FROM v),
p AS (SELECT n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) * 1.0 AS bw, (hi - lo) / 199 AS step FROM s),
d AS (SELECT x, COUNT(*) AS m FROM v GROUP BY x),
e AS (SELECT g.range AS point, CASE WHEN g.range = 199 THEN p.hi ELSE g.range * p.step + p.lo END AS gx
      FROM range(200) g, p)
SELECT e.point, e.gx AS x,
       ROUND(SUM(d.m * exp(-0.5 * ((e.gx - d.x) / p.bw) * ((e.gx - d.x) / p.bw)))
             / (p.n * p.bw * 2.5066282746310002) * p.n * (p.hi - p.lo) / 40, 6) AS density
FROM e, d, p
GROUP BY e.point, e.gx, p.n, p.bw, p.hi, p.lo
ORDER BY e.point
""")
def q_density_curve(spark, sf):
    return TX.density_curve(_t(spark, sf, "documents"), F.length("text"), points=200, count_bins=40,
                            decimals=6)


# --------------------------------------------------------------------- quality

_DOC_COLS = ("doc_id", "text", "lang", "source", "n_chars")


@register("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS nulls FROM documents" for c in _DOC_COLS))
def q_null_counts(spark, sf):
    return Q.null_counts(_t(spark, sf, "documents"), name="column_name")


_PART_COLS = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@register("profile_columns", f"""
WITH long AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM part" for c in _PART_COLS)}),
pv AS (SELECT column_name, value, COUNT(*) AS n FROM long WHERE value IS NOT NULL GROUP BY column_name, value)
SELECT column_name, CAST(SUM(n) AS BIGINT) AS count, COUNT(*) AS "unique",
       first(value ORDER BY n DESC, value) AS top, MAX(n) AS freq
FROM pv GROUP BY column_name ORDER BY column_name
""")
def q_profile_columns(spark, sf):
    return Q.profile_columns(_t(spark, sf, "part")).withColumnRenamed("column", "column_name")


@register("profile_shape", f"SELECT COUNT(*) AS n_rows, CAST({len(_PART_COLS)} AS BIGINT) AS n_columns FROM part")
def q_profile_shape(spark, sf):
    return Q.profile_shape(_t(spark, sf, "part")).toDF("n_rows", "n_columns")


@register("head_rows", """
SELECT * FROM part ORDER BY p_partkey LIMIT 5
""")
def q_head_rows(spark, sf):
    return Q.head_rows(_t(spark, sf, "part"), "p_partkey", 5)


@register("schema_info", """
SELECT 'doc_id' AS column_name, 'bigint' AS type, COUNT(doc_id) AS non_null FROM documents
UNION ALL SELECT 'text', 'string', COUNT(text) FROM documents
UNION ALL SELECT 'lang', 'string', COUNT(lang) FROM documents
UNION ALL SELECT 'source', 'string', COUNT(source) FROM documents
UNION ALL SELECT 'n_chars', 'bigint', COUNT(n_chars) FROM documents
""")
def q_schema_info(spark, sf):
    return Q.schema_info(_t(spark, sf, "documents")).withColumnRenamed("column", "column_name")


@register("unique_violations", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
""")
def q_unique_violations(spark, sf):
    return Q.unique_violations(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("fk_violations", """
SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""")
def q_fk_violations(spark, sf):
    return Q.fk_violations(_t(spark, sf, "documents").select("doc_id", "lang"),
                           _t(spark, sf, "labels"), "doc_id")


@register("orphan_keys", """
SELECT d.doc_id, COUNT(*) AS rows FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY d.doc_id
""")
def q_orphan_keys(spark, sf):
    """Document ids without a label, with the number of documents holding each."""
    return Q.orphan_keys(_t(spark, sf, "documents"), _t(spark, sf, "labels"), "doc_id")


@register("range_violations", """
SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL AND quality NOT BETWEEN 1 AND 4
""")
def q_range_violations(spark, sf):
    return Q.range_violations(_t(spark, sf, "labels"), "quality", 1, 4).select("doc_id", "quality")


@register("length_violations", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS length FROM documents WHERE length(text) > 5000
""")
def q_length_violations(spark, sf):
    return Q.length_violations(_t(spark, sf, "documents"), "text", 5000).select("doc_id", "length")


@register("restrict_delete_blocked", """
SELECT n_nationkey, n_name, n_regionkey FROM nation n
WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_nationkey = n.n_nationkey)
""")
def q_restrict_delete_blocked(spark, sf):
    return Q.restrict_delete_blocked(_t(spark, sf, "nation"), _t(spark, sf, "customer"),
                                     "n_nationkey", "c_nationkey")


@register("cascade_delete", """
SELECT doc_id, quality, toxic FROM labels l
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.lang = 'de' AND d.doc_id = l.doc_id)
""")
def q_cascade_delete(spark, sf):
    deleted = _t(spark, sf, "documents").filter(F.col("lang") == "de").select("doc_id")
    return Q.cascade_delete(_t(spark, sf, "labels"), deleted, "doc_id")


@register("cascade_rekey", """
SELECT c.c_custkey, COALESCE(m.new_key, c.c_nationkey) AS c_nationkey
FROM customer c LEFT JOIN (SELECT n_nationkey AS old_key, n_nationkey + 100 AS new_key
                           FROM nation WHERE n_regionkey = 2) m ON c.c_nationkey = m.old_key
""")
def q_cascade_rekey(spark, sf):
    mapping = (_t(spark, sf, "nation").filter(F.col("n_regionkey") == 2)
               .select(F.col("n_nationkey").alias("old_key"), (F.col("n_nationkey") + 100).alias("new_key")))
    return Q.cascade_rekey(_t(spark, sf, "customer").select("c_custkey", "c_nationkey"), mapping, "c_nationkey")


@register("functional_dependency", """
SELECT p_brand, COUNT(DISTINCT p_type) AS distinct_count FROM part GROUP BY p_brand HAVING COUNT(DISTINCT p_type) > 1
""")
def q_functional_dependency(spark, sf):
    return Q.functional_dependency(_t(spark, sf, "part"), "p_brand", "p_type")


# Natural keys and references of the test tables.
TABLE_CONSTRAINTS = (
    Q.Constraint("region", "primary_key", ("r_regionkey",)),
    Q.Constraint("nation", "primary_key", ("n_nationkey",)),
    Q.Constraint("nation", "foreign_key", ("n_regionkey",), ("region", ("r_regionkey",))),
    Q.Constraint("supplier", "primary_key", ("s_suppkey",)),
    Q.Constraint("supplier", "foreign_key", ("s_nationkey",), ("nation", ("n_nationkey",))),
    Q.Constraint("customer", "primary_key", ("c_custkey",)),
    Q.Constraint("customer", "foreign_key", ("c_nationkey",), ("nation", ("n_nationkey",))),
    Q.Constraint("part", "primary_key", ("p_partkey",)),
    Q.Constraint("orders", "primary_key", ("o_orderkey",)),
    Q.Constraint("orders", "foreign_key", ("o_custkey",), ("customer", ("c_custkey",))),
    Q.Constraint("lineitem", "primary_key", ("l_orderkey", "l_linenumber")),
    Q.Constraint("lineitem", "foreign_key", ("l_orderkey",), ("orders", ("o_orderkey",))),
    Q.Constraint("lineitem", "foreign_key", ("l_partkey",), ("part", ("p_partkey",))),
    Q.Constraint("lineitem", "foreign_key", ("l_suppkey",), ("supplier", ("s_suppkey",))),
    Q.Constraint("events", "primary_key", ("event_id",)),
    Q.Constraint("documents", "primary_key", ("doc_id",)),
    Q.Constraint("documents", "not_null", ("doc_id", "text", "lang", "source")),
    Q.Constraint("documents", "max_length", ("text",), 5000),
    Q.Constraint("labels", "primary_key", ("doc_id",)),
    Q.Constraint("labels", "foreign_key", ("doc_id",), ("documents", ("doc_id",))),
    Q.Constraint("labels", "between", ("quality",), (1, 4)),
    Q.Constraint("conversations", "primary_key", ("conv_id", "turn")),
)


def _constraint_sql(c) -> str:
    cols = list(c.columns)
    head = f"SELECT '{c.table}' AS table_name, '{c.kind}' AS kind, '{','.join(cols)}' AS columns, "
    if c.kind == "not_null":
        return head + f"COUNT(*) AS violations FROM {c.table} WHERE " + " OR ".join(f"{x} IS NULL" for x in cols)
    if c.kind == "primary_key":
        k = ", ".join(cols)
        return head + f"COUNT(*) AS violations FROM (SELECT {k} FROM {c.table} GROUP BY {k} HAVING COUNT(*) > 1)"
    if c.kind == "foreign_key":
        parent, pcols = c.arg
        on = " AND ".join(f"p.{p} = c.{x}" for x, p in zip(cols, pcols))
        nn = " AND ".join(f"c.{x} IS NOT NULL" for x in cols)
        return head + (f"COUNT(*) AS violations FROM {c.table} c WHERE {nn} AND NOT EXISTS "
                       f"(SELECT 1 FROM {parent} p WHERE {on})")
    if c.kind == "between":
        lo, hi = c.arg
        return head + (f"COUNT(*) AS violations FROM {c.table} WHERE {cols[0]} IS NOT NULL "
                       f"AND {cols[0]} NOT BETWEEN {lo} AND {hi}")
    if c.kind == "max_length":
        return head + f"COUNT(*) AS violations FROM {c.table} WHERE length({cols[0]}) > {c.arg}"
    raise ValueError(c.kind)


@register("constraint_report", "\nUNION ALL\n".join(_constraint_sql(c) for c in TABLE_CONSTRAINTS))
def q_constraint_report(spark, sf):
    names = sorted({c.table for c in TABLE_CONSTRAINTS})
    return Q.constraint_report({n: _t(spark, sf, n) for n in names}, TABLE_CONSTRAINTS)


# ----------------------------------------------------------------- preparation

_SOURCE_SORTED = "SELECT ROW_NUMBER() OVER (ORDER BY source) AS id, source FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)"
_SOURCE_FIRST = ("SELECT ROW_NUMBER() OVER (ORDER BY first_id, source) AS id, source FROM "
                 "(SELECT source, MIN(doc_id) AS first_id FROM documents WHERE source IS NOT NULL GROUP BY source)")
_LANG_SORTED = "SELECT ROW_NUMBER() OVER (ORDER BY lang) AS id, lang FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)"


@register("dimension_sorted", _SOURCE_SORTED)
def q_dimension_sorted(spark, sf):
    return P.build_dimension(_t(spark, sf, "documents"), "source", mode="sorted")


@register("dimension_first_seen", _SOURCE_FIRST)
def q_dimension_first_seen(spark, sf):
    return P.build_dimension(_t(spark, sf, "documents"), "source", mode="first_seen", order_col="doc_id")


@register("encode_fact", f"""
WITH ld AS ({_LANG_SORTED}), sd AS ({_SOURCE_FIRST})
SELECT d.doc_id, ld.id AS lang_id, sd.id AS source_id
FROM documents d LEFT JOIN ld ON d.lang = ld.lang LEFT JOIN sd ON d.source = sd.source
""")
def q_encode_fact(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source")
    dims = P.build_dimensions(docs, [("lang", "lang_id", "sorted"), ("source", "source_id", "first_seen")],
                              order_col="doc_id")
    return P.encode_fact(docs, [("lang", dims["lang"], "lang", "lang_id"),
                                ("source", dims["source"], "source", "source_id")])


@register("prepare_star", f"""
WITH f AS (SELECT doc_id, lang, source, {_DOC_CASE} AS concept FROM documents WHERE lang IN ('en', 'de')),
ld AS (SELECT ROW_NUMBER() OVER (ORDER BY lang) AS lang_id, lang FROM (SELECT DISTINCT lang FROM f)),
sd AS (SELECT ROW_NUMBER() OVER (ORDER BY first_id, source) AS source_id, source
       FROM (SELECT source, MIN(doc_id) AS first_id FROM f GROUP BY source)),
cd AS (SELECT ROW_NUMBER() OVER (ORDER BY concept) AS concept_id, concept FROM (SELECT DISTINCT concept FROM f))
SELECT f.doc_id, ld.lang_id, sd.source_id, cd.concept_id
FROM f LEFT JOIN ld ON f.lang = ld.lang LEFT JOIN sd ON f.source = sd.source LEFT JOIN cd ON f.concept = cd.concept
""")
def q_prepare_star(spark, sf):
    flat = _t(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    star = P.build_star(flat, "doc_id",
                        [("lang", "lang_id", "sorted"), ("source", "source_id", "first_seen"),
                         ("concept", "concept_id", "sorted")],
                        category_col="lang", keep=["en", "de"], text_col="text",
                        rules=DOC_RULES, default=DOC_DEFAULT)
    return star.fact.select("doc_id", "lang_id", "source_id", "concept_id")


@register("file_order_ids", """
SELECT ROW_NUMBER() OVER (ORDER BY event_id) AS seq, event_id, event_type
FROM events WHERE event_type IN ('error', 'purchase')
""")
def q_file_order_ids(spark, sf):
    """Ids 1..n by file and position for the kept rows (the events are stored by event_id)."""
    kept = P.filter_categories(_t(spark, sf, "events"), "event_type", ["error", "purchase"])
    return sequence_ids(kept.select("event_id", "event_type"), "seq")


@register("escape_literal", r"""
SELECT doc_id, replace(replace(text, '\', '\\'), '''', '''''') AS escaped FROM documents
""")
def q_escape_literal(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", escape_literal("text").alias("escaped"))


@register("preview_left", """
SELECT doc_id, left(text, 70) AS preview70,
       CASE WHEN length(text) > 80 THEN left(text, 80) || '...' ELSE text END AS short80
FROM documents
""")
def q_preview_left(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", left("text", 70).alias("preview70"),
                                             preview("text", 80).alias("short80"))


# ------------------------------------------------------------------ feedback

CONV_TEMPLATE = ("Conversation {conv_id}, turn {turn}.\nSpeaker: {role}\n\nMessage:\n{text}\n\n"
                 "Write the reply this speaker should receive.")


@register("render_prompt", r"""
SELECT conv_id, turn,
       'Conversation ' || CAST(conv_id AS VARCHAR) || ', turn ' || CAST(turn AS VARCHAR) || '.' || chr(10)
       || 'Speaker: ' || role || chr(10) || chr(10) || 'Message:' || chr(10) || text || chr(10) || chr(10)
       || 'Write the reply this speaker should receive.' AS prompt
FROM conversations
""")
def q_render_prompt(spark, sf):
    conv = _t(spark, sf, "conversations")
    fields = {k: k for k in ("conv_id", "turn", "role", "text")}
    return conv.select("conv_id", "turn", render_template(CONV_TEMPLATE, fields).alias("prompt"))


@register("clean_response", """
SELECT conv_id, turn, trim(text, ' ' || chr(10) || chr(9) || chr(13) || chr(11) || chr(12)) AS text
FROM conversations
""")
def q_clean_response(spark, sf):
    return FB.clean_response(_t(spark, sf, "conversations"), "text").select("conv_id", "turn", "text")


DOC_TEMPLATE = ("Pattern {frequency_rank}: {frequency} documents in language \"{lang}\".\n"
                "Example from source {source}:\n{text}\n\nWrite short feedback on this example.")

_WORKLIST_SQL = """
WITH c AS (SELECT lang, COUNT(*) AS frequency FROM documents GROUP BY lang),
t AS (SELECT lang, frequency, ROW_NUMBER() OVER (ORDER BY frequency DESC, lang) AS frequency_rank
      FROM c ORDER BY frequency DESC, lang LIMIT 3),
e AS (SELECT lang, MIN(doc_id) AS example_id FROM documents GROUP BY lang),
w AS (SELECT t.frequency_rank, t.lang, t.frequency, e.example_id,
             'Pattern ' || CAST(t.frequency_rank AS VARCHAR) || ': ' || CAST(t.frequency AS VARCHAR)
             || ' documents in language "' || t.lang || '".' || chr(10) || 'Example from source ' || d.source
             || ':' || chr(10) || d.text || chr(10) || chr(10) || 'Write short feedback on this example.' AS prompt
      FROM t JOIN e ON t.lang = e.lang JOIN documents d ON d.doc_id = e.example_id)
"""


def worklist(spark, sf):
    """The three most frequent languages with their first document and prompt."""
    return FB.feedback_worklist(_t(spark, sf, "documents"), "lang", 3, "doc_id", DOC_TEMPLATE,
                                {"frequency_rank": "frequency_rank", "frequency": "frequency",
                                 "lang": "lang", "source": "source", "text": "text"},
                                example_columns=["source", "text"])


@register("feedback_worklist", _WORKLIST_SQL + "SELECT * FROM w")
def q_feedback_worklist(spark, sf):
    return worklist(spark, sf).select("frequency_rank", "lang", "frequency", "example_id", "prompt")


def review_service(prompts: pd.Series) -> pd.Series:
    """Stand-in for the external text service used by the registered queries:
    a pure, deterministic batch function."""
    return "reviewed: " + prompts.str.len().astype(str) + " characters"


_REVIEW_SQL = "'reviewed: ' || CAST(length(w.prompt) AS VARCHAR) || ' characters'"


@register("enrich_rows", _WORKLIST_SQL + f"SELECT w.frequency_rank, w.lang, {_REVIEW_SQL} AS response FROM w")
def q_enrich_rows(spark, sf):
    return (FB.enrich_rows(worklist(spark, sf), review_service, "prompt")
              .select("frequency_rank", "lang", "response"))


RESULT_SCHEMA = StructType([
    StructField("feedback_id", LongType()), StructField("lang", StringType()),
    StructField("example_id", LongType()), StructField("prompt_text", StringType()),
    StructField("generated_feedback", StringType()), StructField("frequency_rank", LongType()),
    StructField("error_frequency", LongType()),
])


@register("feedback_report", _WORKLIST_SQL + f"""
SELECT w.frequency_rank, w.lang, w.frequency AS error_frequency, left({_REVIEW_SQL}, 70) AS preview
FROM w ORDER BY w.frequency_rank
""")
def q_feedback_report(spark, sf):
    enriched = FB.enrich_rows(worklist(spark, sf), review_service, "prompt")
    rows = enriched.select(F.lit(None).cast("long").alias("feedback_id"), "lang", "example_id",
                           F.col("prompt").alias("prompt_text"),
                           F.col("response").alias("generated_feedback"), "frequency_rank",
                           F.col("frequency").alias("error_frequency"))
    stored = S.upsert_by_key(spark.createDataFrame([], RESULT_SCHEMA), rows.drop("feedback_id"),
                             "lang", id_col="feedback_id")
    return FB.feedback_report(stored, "frequency_rank", "generated_feedback", ["lang", "error_frequency"])


@register("feedback_job", ORACLE_SQL["feedback_report"])
def q_feedback_job(spark, sf):
    fields = {"frequency_rank": "frequency_rank", "frequency": "frequency", "lang": "lang",
              "source": "source", "text": "text"}
    return FB.feedback_job(_t(spark, sf, "documents"), "lang", 3, "doc_id", DOC_TEMPLATE, fields,
                           review_service, out_path=scratch_path(spark, "feedback_v1"),
                           model_name="review-service", example_columns=["source", "text"])


# ------------------------------------------------------------------- sources

@register("upsert_by_key", """
WITH m AS (SELECT MIN(event_id) + MAX(event_id) AS s FROM events),
o AS (SELECT user_id, COUNT(*) AS count FROM events, m WHERE NOT COALESCE(event_id * 2 >= m.s, FALSE) GROUP BY user_id),
n AS (SELECT user_id, COUNT(*) AS count FROM events, m WHERE event_id * 2 >= m.s GROUP BY user_id)
SELECT CASE WHEN n.count IS NOT NULL THEN n.user_id ELSE o.user_id END AS user_id,
       COALESCE(n.count, o.count) AS count,
       CASE WHEN n.count IS NOT NULL AND o.count IS NOT NULL THEN 'update'
            WHEN n.count IS NOT NULL THEN 'insert' ELSE 'keep' END AS change
FROM o FULL OUTER JOIN n ON o.user_id IS NOT DISTINCT FROM n.user_id
""")
def q_upsert_by_key(spark, sf):
    """Events per user in the first half merged with the second half's: users
    of both halves are updated, of the second inserted, of the first kept."""
    events = _t(spark, sf, "events")
    mid = events.select(F.min("event_id") + F.max("event_id")).scalar()
    late = F.coalesce(F.col("event_id") * 2 >= mid, F.lit(False))  # no id: an early event
    counts = (events.groupBy("user_id", late.alias("_late"))
                    .agg(F.count(F.lit(1)).alias("count")))
    old = counts.filter(~F.col("_late")).drop("_late")
    new = counts.filter(F.col("_late")).drop("_late")
    return S.upsert_by_key(old, new, "user_id", change_col="change")


@register("stream_counts", """
SELECT event_type, COUNT(*) AS count FROM events GROUP BY event_type
""")
def q_stream_counts(spark, sf):
    """Event counts as a streaming aggregation: the events read as a file
    stream, Spark's own state per type, the final totals written once."""
    base = sf.rstrip("/")
    stream = (spark.readStream.schema(_t(spark, sf, "events").schema).option("recursiveFileLookup", "true")
                   .option("pathGlobFilter", "*.parquet").parquet(f"{base}/events.parquet*"))
    out, ckpt = scratch_path(spark, "stream_counts"), scratch_path(spark, "stream_counts_ckpt")
    counts = stream.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))
    query = (counts.writeStream.outputMode("complete").option("checkpointLocation", ckpt)
             .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema("event_type string, count long").parquet(out)


_ORDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@register("append_rows", f"SELECT {_ORDER_COLS} FROM orders")
def q_append_rows(spark, sf):
    orders = _t(spark, sf, "orders")
    path = scratch_path(spark, "orders_appended")
    orders.filter(F.col("o_orderstatus") == "F").write.parquet(path)
    S.append_rows(orders.filter((F.col("o_orderstatus") != "F") | F.col("o_orderstatus").isNull()), path)
    return spark.read.parquet(path)


@register("append_with_ids", """
WITH b AS (SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS id, c_custkey, c_name
           FROM customer WHERE c_mktsegment = 'BUILDING'),
mx AS (SELECT COALESCE(MAX(id), 0) AS m FROM b)
SELECT id, c_custkey, c_name FROM b
UNION ALL
SELECT mx.m + ROW_NUMBER() OVER (ORDER BY c.c_custkey) AS id, c.c_custkey, c.c_name
FROM customer c, mx WHERE c.c_mktsegment IS DISTINCT FROM 'BUILDING'
""")
def q_append_with_ids(spark, sf):
    cust = _t(spark, sf, "customer")
    path = scratch_path(spark, "customer_ids")
    base = cust.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    first = S.next_ids(spark.createDataFrame([], "id long, c_custkey long, c_name string"), base, "id",
                       ["c_custkey"])
    first.write.parquet(path)
    rest = cust.filter(~F.col("c_mktsegment").eqNullSafe(F.lit("BUILDING"))).select("c_custkey", "c_name")
    S.append_with_ids(spark, path, rest, "id", ["c_custkey"])
    return spark.read.parquet(path)


@register("scan_csv_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_scan_csv_roundtrip(spark, sf):
    docs = _t(spark, sf, "documents")
    path = scratch_path(spark, "documents_csv")
    S.write_csv(docs, path)
    return S.read_csv(spark, path, docs.schema)


# ------------------------------------------------- names joined to results

@register("dominant_part_names", """
WITH c AS (SELECT l_suppkey, l_partkey, COUNT(*) AS cnt FROM lineitem GROUP BY l_suppkey, l_partkey),
r AS (SELECT *, CAST(SUM(cnt) OVER (PARTITION BY l_suppkey) AS BIGINT) AS total,
             RANK() OVER (PARTITION BY l_suppkey ORDER BY cnt DESC) AS rnk FROM c)
SELECT s.s_name, p.p_name, r.cnt AS dominant_count, r.total
FROM r JOIN supplier s ON r.l_suppkey = s.s_suppkey JOIN part p ON r.l_partkey = p.p_partkey WHERE r.rnk = 1
""")
def q_dominant_part_names(spark, sf):
    """Each supplier's most frequent part(s): ranked on ids, names joined to the top rows only."""
    top = A.dominant_member(_t(spark, sf, "lineitem"), "l_suppkey", "l_partkey", threshold=40, sort=False)
    names = _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    parts = _t(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return top.join(names, "l_suppkey").join(parts, "l_partkey").select("s_name", "p_name", "dominant_count", "total")


@register("example_with_names", """
WITH e AS (SELECT o_orderpriority, MIN(o_orderkey) AS o_orderkey FROM orders GROUP BY o_orderpriority)
SELECT e.o_orderpriority, e.o_orderkey, o.o_totalprice, c.c_name
FROM e JOIN orders o ON o.o_orderkey = e.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
""")
def q_example_with_names(spark, sf):
    """The first order of every priority, its customer looked up afterwards."""
    customer = Dim(_t(spark, sf, "customer"), on="o_custkey", key="c_custkey", columns=["c_name"])
    return FB.first_example_per_group(_t(spark, sf, "orders"), "o_orderpriority", "o_orderkey",
                                      ["o_totalprice", "o_custkey"], dims=[customer]).select(
        "o_orderpriority", "o_orderkey", "o_totalprice", "c_name")


_STORED_AT = "2024-01-02 03:04:05"


@register("stored_report_with_names", f"""
WITH c AS (SELECT c_nationkey, COUNT(*) AS frequency FROM customer GROUP BY c_nationkey),
t AS (SELECT *, ROW_NUMBER() OVER (ORDER BY frequency DESC, c_nationkey) AS frequency_rank FROM c),
e AS (SELECT c_nationkey, MIN(c_custkey) AS example_id FROM customer GROUP BY c_nationkey),
w AS (SELECT t.*, x.c_name FROM t JOIN e ON t.c_nationkey = e.c_nationkey JOIN customer x ON x.c_custkey = e.example_id
      WHERE t.frequency_rank <= 10 AND t.c_nationkey % 2 = 0)
SELECT w.frequency_rank, n.n_name, w.frequency AS error_frequency, left('about ' || w.c_name, 12) AS preview,
       TIMESTAMP '{_STORED_AT}' AS generated_at
FROM w JOIN nation n ON n.n_nationkey = w.c_nationkey
""")
def q_stored_report_with_names(spark, sf):
    """The ten most frequent nations; a nation without an example name (odd
    keys) is skipped and leaves a gap in the ranks; results are stored with a
    given time and reported with the nation's name."""
    named = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name"))
    customers = _t(spark, sf, "customer").select("c_nationkey", "c_custkey", named.alias("c_name"))
    work = FB.feedback_worklist(customers, "c_nationkey", 10, "c_custkey", "about {name}", {"name": "c_name"},
                                example_columns=["c_name"])
    done = FB.enrich_rows(work, pass_through, "prompt")
    rows = done.select("c_nationkey", F.col("response").alias("generated_feedback"), "frequency_rank",
                       F.col("frequency").alias("error_frequency"))
    old = spark.createDataFrame([], StructType([*rows.schema.fields, StructField("generated_at", TimestampNTZType())]))
    now = datetime.fromisoformat(_STORED_AT)
    stored = S.upsert_by_key(old, rows, "c_nationkey", touched_col="generated_at", now=now)
    nation = Dim(_t(spark, sf, "nation"), on="c_nationkey", key="n_nationkey", columns=["n_name"])
    return FB.feedback_report(stored, "frequency_rank", "generated_feedback", ["n_name", "error_frequency", "generated_at"],
                              dims=[nation], preview_chars=12).select(
        "frequency_rank", "n_name", "error_frequency", "preview", "generated_at")


def pass_through(prompts: pd.Series) -> pd.Series:
    """A service that returns its prompts."""
    return prompts
