"""The operators of this package bound to the given tables.

``QUERIES`` maps each key to a callable over (spark, table folder);
``ORACLE_SQL`` holds a DuckDB statement where SQL can express the result.
Operators without one are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe_codec import round_trip
from . import licences, quality, toxicity
from .fingerprints import edited_fingerprints
from .frames import read_table, release_driver
from .labelled import bounded_sample, id_remainder, training_sample
from .lexical_search import rank_documents
from .licences import scan_licences
from .merkle import manifest_of
from .mixing import mix_sources
from .near_dedup import near_duplicates
from .neighbours import nearest_neighbours
from .repeats import remove_repeats
from .token_counts import count_tokens
from .token_files import ids_crc32, read_token_files, write_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

DECIDE_FROM = 0.3  # score from which a document is of label 1
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


@register("op6_token_counts")
def op6_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return count_tokens(docs, BYTE_BPE).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def codec_digests(docs: DataFrame) -> DataFrame:
    """Encoded and decoded documents as their digests."""
    both = round_trip(docs.select("doc_id", "text"), BYTE_BPE)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@register("op9_bpe_codec")
def op9_bpe_codec(spark: SparkSession, sf: str) -> DataFrame:
    return codec_digests(read_table(spark, sf, "documents"))


@register("op8_token_files")
def op8_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(read_table(spark, sf, "documents"), path, BYTE_BPE, end_id=2)
    tokens = read_token_files(spark, path).select("doc_id", "start", "n_tokens", "ids")
    return ids_crc32(tokens).drop("ids")


@register("op4_near_duplicates")
def op4_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf, "documents"), words=4, percent=80)


@register("op5_repeats")
def op5_repeats(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    return remove_repeats(docs, min_bytes=50).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    learn = id_remainder("doc_id", 4) != 2
    sample = bounded_sample(docs, labels, "toxic", learn, toxicity.PER_LABEL, toxicity.TRAIN_BYTES, toxicity.LONGEST_BYTES)
    model = toxicity.train_sampled(toxicity.sampled_bags(sample))
    release_driver(docs.sparkSession)
    return model


def with_decision(scored: DataFrame, modulus: int, held: int) -> DataFrame:
    return scored.select(
        "doc_id", F.coalesce(id_remainder("doc_id", modulus) == held, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= DECIDE_FROM).cast("int").alias("predicted"))


@register("op2_quality")
def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = read_table(spark, sf, "documents").select("doc_id", "text"), read_table(spark, sf, "labels")
    learn = id_remainder("doc_id", 5) != 0
    model = quality.train(training_sample(docs, labels, "quality", learn, quality.PER_LABEL, quality.TRAIN_BYTES))
    return with_decision(quality.score(docs, model), 5, 0)


@register("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = read_table(spark, sf, "documents").select("doc_id", "text"), read_table(spark, sf, "labels")
    return with_decision(toxicity.score(docs, toxicity_model(docs, labels)), 4, 2)


@register("op7_fingerprints")
def op7_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return edited_fingerprints(read_table(spark, sf, "documents"))


@register("op3_mixing", """
    WITH d AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
               md5('mix-1' || coalesce(doc_id::VARCHAR, '') || md5(coalesce(text, ''))) AS h, md5(coalesce(text, '')) AS t
        FROM documents),
    s0 AS (
        SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS i
        FROM d GROUP BY source),
    s1 AS (
        SELECT *, [5, 2, 1][(i - 1) % 3 + 1]::BIGINT AS w, 2 * source_size AS cap,
               (sum(source_size) OVER () * 150)::DOUBLE / 100.0 AS budget
        FROM s0),
    s2 AS (
        SELECT *, sum(cap) OVER o - cap AS before, sum(w) OVER () - sum(w) OVER o + w AS rest
        FROM s1 WINDOW o AS (ORDER BY cap::DOUBLE / w, i ROWS UNBOUNDED PRECEDING)),
    s3 AS (SELECT *, (cap * rest)::DOUBLE <= w * (budget - before::DOUBLE) AS capped FROM s2),
    s AS (
        SELECT source, source_size, i, w, budget,
               CASE WHEN capped THEN cap::DOUBLE
                    ELSE w * (budget - (sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE)
                         / (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())::DOUBLE END AS target
        FROM s3),
    p AS (
        SELECT d.*, s.source_size, s.i, s.w, s.budget, s.target,
               sum(d.size) OVER (PARTITION BY s.i ORDER BY h, t ROWS UNBOUNDED PRECEDING) AS upto
        FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
    q AS (
        SELECT doc_id, h, t, i, size, budget, (k * source_size + upto)::DOUBLE / w AS finish
        FROM p, (VALUES (0), (1)) v(k) WHERE size > 0),
    r AS (SELECT *, sum(size) OVER (ORDER BY finish, i, h, t ROWS UNBOUNDED PRECEDING) AS held FROM q),
    n AS (SELECT doc_id, h, t, i, sum(size)::BIGINT AS taken FROM r WHERE held <= budget GROUP BY ALL)
    SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(n.taken, 0)::BIGINT AS taken
    FROM p LEFT JOIN n ON p.doc_id IS NOT DISTINCT FROM n.doc_id AND p.h = n.h AND p.t = n.t AND p.i = n.i""")
def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


@register("op1_neighbours")
def op1_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf, "embeddings").select("vec_id", "embedding"),
                              is_query=F.col("vec_id") % 20 == 0, k=20)


@register("op11_licences")
def op11_licences(spark: SparkSession, sf: str) -> DataFrame:
    found = scan_licences(read_table(spark, sf, "documents").select("doc_id", "text"))
    words = licences.base_places()
    return found.select(
        "doc_id", "n_words", F.size(words).cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), F.array_join(licences.base_labels(), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score")


@register("op12_search", """
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws
        FROM documents),
    q AS (
        SELECT row_number() OVER () AS i, item_id,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws
        FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
    qt AS (SELECT i, t, count(*)::BIGINT AS times FROM (SELECT i, unnest(ws) AS t FROM q) GROUP BY i, t),
    s AS (SELECT count(*)::BIGINT AS n_docs, sum(len(ws))::BIGINT AS n_terms FROM d WHERE len(ws) > 0),
    dt AS (
        SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ws) AS t FROM d)
        WHERE t IN (SELECT t FROM qt) GROUP BY r, t),
    w AS (
        SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
        FROM dt, s GROUP BY t, n_docs),
    m AS (SELECT r, doc_id, (75 + (25 * len(ws)::BIGINT * n_docs) // n_terms)::BIGINT AS m FROM d, s WHERE len(ws) > 0),
    x AS (
        SELECT qt.i, dt.r, m.doc_id, sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * m.m)))::BIGINT AS score
        FROM qt JOIN w USING (t) JOIN dt USING (t) JOIN m USING (r) GROUP BY ALL)
    SELECT q.item_id, (row_number() OVER o)::INTEGER AS rank, x.doc_id, x.score
    FROM x JOIN q USING (i) WHERE score > 0
    WINDOW o AS (PARTITION BY x.i ORDER BY score DESC, x.doc_id NULLS LAST) QUALIFY rank <= 20""")
def op12_search(spark: SparkSession, sf: str) -> DataFrame:
    return rank_documents(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"), k=20)


@register("op13_manifest", """
    WITH RECURSIVE d AS (
        SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS tree,
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
               text, replace(text, chr(10), '') AS less,
               list_reduce(list_concat([4294967295], flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]
                                                              FOR c IN string_split(doc_id::VARCHAR, '')])),
                           lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
               AS crc
        FROM documents),
    l AS (
        SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN sha256(head || coalesce(strlen(less) || ':' || less, '-')) END AS altered
        FROM d),
    p AS (SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, leaf) AS r,
                 row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                 count(*) OVER (PARTITION BY tree) AS n FROM l),
    a AS (
        SELECT tree, 0 AS h, i, n, leaf AS x FROM p
        UNION ALL
        SELECT tree, h + 1, i // 3, (n + 2) // 3, sha256(string_agg(x, '' ORDER BY i)) FROM a WHERE n > 1
        GROUP BY tree, h, i // 3, n),
    s AS (
        SELECT tree, x AS subroot, h AS height, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM a WHERE n = 1),
    b AS (
        SELECT 0 AS h, i, n, subroot AS x FROM s
        UNION ALL
        SELECT h + 1, i // 3, (n + 2) // 3, sha256(string_agg(x, '' ORDER BY i)) FROM b WHERE n > 1 GROUP BY h, i // 3, n),
    u AS (
        SELECT tree, h, i, x FROM a WHERE n > 1
        UNION ALL SELECT s.tree, s.height + b.h, b.i, b.x FROM b, s WHERE b.n > 1),
    w AS (
        SELECT p.r, p.tree, 0 AS h, CASE WHEN s.height = 0 THEN s.i ELSE p.i END AS i, coalesce(altered, leaf) AS x, s.height, s.i AS si, ''
               AS siblings
        FROM p JOIN s USING (tree)
        UNION ALL
        SELECT w.r, w.tree, w.h + 1, CASE WHEN w.h + 1 = height THEN si ELSE w.i // 3 END,
               sha256(string_agg(CASE WHEN u.i = w.i THEN w.x ELSE u.x END, '' ORDER BY u.i)), height, si,
               siblings || coalesce(string_agg(CASE WHEN u.i <> w.i THEN u.x END, '' ORDER BY u.i), '')
        FROM w JOIN u ON u.tree = w.tree AND u.h = w.h AND u.i // 3 = w.i // 3
        GROUP BY w.r, w.tree, w.h, w.i, w.height, w.si, w.siblings)
    SELECT p.doc_id, p.leaf, s.subroot, (SELECT x FROM b WHERE n = 1) AS root, sha256(e.siblings) AS proof_sha256,
           e.x AS folded_root, e.x = (SELECT x FROM b WHERE n = 1) AS verified
    FROM p JOIN s USING (tree) JOIN (SELECT * FROM w QUALIFY row_number() OVER (PARTITION BY r ORDER BY h DESC) = 1) e USING (r)""")
def op13_manifest(spark: SparkSession, sf: str) -> DataFrame:
    def hexed(column: str):
        return F.lower(F.hex(column))

    paths = manifest_of(read_table(spark, sf, "documents"))
    return paths.select(
        "doc_id", *[hexed(c).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(hexed("siblings"), 256).alias("proof_sha256"),
        hexed("folded_root").alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))
