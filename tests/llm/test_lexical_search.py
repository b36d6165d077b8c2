"""Ranked search against plain Python and against its SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import lexical_search as S
from faultline.llm import queries as Q
from tests.llm.helpers import awkward_texts, docs, prose


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_force(rows, items, k=20):
    """Sorted (item id, rank, doc id, score)"""
    counted = [(i, Counter(terms(t))) for i, t in rows]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in sorted({x for x in items if x[1] is not None}, key=str):
        scores = []
        for i, c, n in counted:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in Counter(terms(text)).items() if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id LONG, text STRING")


def corpus(seed, n):
    rng = random.Random(seed)
    texts = [prose(rng.randrange(60), rng.choice([1, 5, 20, 80])) for _ in range(n)] + awkward_texts()  # repeated: ties
    queries = [(q, prose(rng.randrange(10 ** 6), rng.choice([1, 4, 30]))) for q in range(25)]
    return list(enumerate(texts)), queries + [(90, None), (91, ""), (92, "absent-word"), (93, "WORDS words"), (None, "two words")]


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows, queries = corpus(seed, 300)
    df = docs(spark, [t for _, t in rows]).repartition(5)
    assert rows_of(S.rank_documents(df, items(spark, queries))) == brute_force(rows, queries)


def test_small_tiles_and_blocks_change_nothing(spark, monkeypatch):
    rows, queries = corpus(3, 200)
    queries += [(7, "the of and"), (7, "the of and"), (7, "another one of the words")]  # one id, two texts
    df = docs(spark, [t for _, t in rows]).repartition(3)
    want = brute_force(rows, queries, k=7)
    for name, value in (("QUERY_TILE", 4), ("DOC_TILE", 16), ("TERM_TILE", 8), ("LONG_BYTES", 50), ("BLOCK_BYTES", 900)):
        monkeypatch.setattr(S, name, value)
    assert rows_of(S.rank_documents(df, items(spark, queries), k=7)) == want


def test_sums_beyond_float64_are_exact():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 25000, (5, 40)) * rng.choice([1, 1000, 10 ** 5, 10 ** 6], (5, 40))
    impacts = rng.integers(0, S.SCALE, (7, 40))
    assert (S.exact_product(weights, impacts) == weights @ impacts.T).all()
    assert weights.sum(axis=1).max() * S.SCALE > S.EXACT


def test_long_items_count_every_repeat(spark):
    rows = [(0, "a b"), (1, "a"), (2, "c c c"), (3, "b b a"), (4, "d")]
    queries = [(1, "a " * 200000 + "b"), (2, "c " * 3)]
    assert rows_of(S.rank_documents(docs(spark, [t for _, t in rows]), items(spark, queries))) == brute_force(rows, queries)


def test_oracle_sql(spark, tmp_path):
    rows, queries = corpus(5, 120)
    docs(spark, [t for _, t in rows]).write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, queries).write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    want = sorted(con.execute(Q.ORACLE_SQL["op12_search"]).fetchall(), key=str)
    assert rows_of(Q.QUERIES["op12_search"](spark, str(tmp_path))) == want


def test_odd_rows_and_empty_tables(spark):
    none = items(spark, [])
    assert S.rank_documents(docs(spark, ["a"]), none).collect() == []
    assert S.rank_documents(docs(spark, []), items(spark, [(1, "a")])).collect() == []
    assert S.rank_documents(docs(spark, [None, "", "- -"]), items(spark, [(1, "a")])).columns == ["item_id", "rank", "doc_id", "score"]
    rows = [(None, "x y"), (None, "x y"), (5, "x y"), (5, "x y"), (3, "z"), (1, None)]
    odd = docs(spark, [t for _, t in rows], ids=[i for i, _ in rows]).withColumn("rank", F.lit("r")).withColumn("score", F.lit(1))
    assert rows_of(S.rank_documents(odd, items(spark, [(1, "x")]))) == brute_force(rows, [(1, "x")])
