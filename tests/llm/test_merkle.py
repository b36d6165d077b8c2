"""The manifest against plain-Python trees and against its SQL."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import merkle as M
from faultline.llm import queries as Q
from tests.llm.helpers import DOCS, awkward_texts, docs, prose


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def climb(tree, i):
    """Runs of the siblings from leaf i up: (own place, the run)."""
    for level in tree[:-1]:
        yield i % 3, level[i // 3 * 3:i // 3 * 3 + 3]
        i //= 3


def brute_force(rows):
    """Sorted contract rows of (doc_id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted([r for r in rows if r[1] == s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources}
    trees = {s: levels([leaf(r) for r in own[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(own[s]):
            runs = [*climb(trees[s], i), *climb(top, k)]
            proof = h(*[x for place, run in runs for j, x in enumerate(run) if j != place])
            start = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                start = leaf((*r[:4], r[4].replace("\n", "")))
            for place, run in runs:
                start = h(*run[:place], start, *run[place + 1:])
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, proof, start, start == root))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n) for i, s, lang, n, t in rows], DOCS)


def corpus(seed, n):
    rng = random.Random(seed)
    texts = [prose(rng.randrange(10 ** 6), rng.choice([0, 3, 30])) + rng.choice(["", "\n", "\nx"]) for _ in range(n)] + awkward_texts()
    sources = [rng.choice(["big"] * 8 + ["a", "ü", "Z", "", None, "mid", "mid"]) for _ in texts]
    sources[:2] = ["one", "two"]
    return [(i * 7 - 50, s, rng.choice(["en", None]), rng.choice([len(t or ""), None]), t)
            for i, (t, s) in enumerate(zip(texts, sources))]


def query(spark, rows, tmp_path):
    table(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.QUERIES["op13_manifest"](spark, str(tmp_path))
    assert got.columns == COLUMNS
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.mark.parametrize("block_levels", [1, 2, 6])
def test_matches_brute_force(spark, tmp_path, monkeypatch, block_levels):
    monkeypatch.setattr(M, "BLOCK_LEVELS", block_levels)
    monkeypatch.setattr(M, "BLOCK_LEAVES", 3 ** block_levels)
    rows = corpus(block_levels, 300)
    assert query(spark, rows, tmp_path) == brute_force(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 82])
def test_one_source_of_every_shape(spark, tmp_path, n):
    rows = [(i, "s", "en", 1, f"t{i}\n") for i in range(n)]
    got = query(spark, rows, tmp_path)
    assert got == brute_force(rows) and len(got) == n
    if n == 1:
        assert got[0][1] == got[0][2] == got[0][3]


def test_oracle_sql(spark, tmp_path):
    rows = corpus(9, 200)
    got = query(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(Q.ORACLE_SQL["op13_manifest"]).fetchall(), key=str) == got


@pytest.mark.parametrize("height", range(0, 8))
def test_layout_places_every_node_once_and_subtrees_together(height):
    at = [M.veb_address(height, d, np.arange(3 ** d)) for d in range(height + 1)]
    assert sorted(np.concatenate(at).tolist()) == list(range((3 ** (height + 1) - 1) // 2))
    assert at[0].tolist() == [0]
    top = (height + 1) // 2
    if height:  # each lower subtree is one run of neighbouring places
        low = [np.concatenate([at[d][i * 3 ** (d - top):(i + 1) * 3 ** (d - top)] for d in range(top, height + 1)])
               for i in range(3 ** top)]
        assert all(x.max() - x.min() + 1 == len(x) for x in low)


def test_stored_subtrees_hold_every_node(spark):
    rows = corpus(4, 900)
    leaves = table(spark, rows).select("source", "doc_id", M.leaf_digest([F.col(c) for c in M.FIELDS]).alias("digest"))
    paths, stored = M.merkle_paths(leaves, ["doc_id"], ["doc_id"])
    top = stored.where("of_dataset").collect()
    assert len(top) == 1 and {r.root.hex() for r in paths.select("root").distinct().collect()} == {top[0].root.hex()}
    big = stored.where("source = 'big' AND NOT of_dataset").orderBy("tier", "subtree").collect()
    members = sorted([r for r in rows if r[1] == "big"], key=lambda r: r[0])
    for block in big:
        if block.tier == 0:
            at = M.veb_address(block.height, block.height, np.arange(block.leaves))
            nodes = [block.nodes[i * 32:i * 32 + 32].hex() for i in at.tolist()]
            assert nodes == [leaf(r) for r in members[block.subtree * 729:(block.subtree + 1) * 729]]
        assert block.nodes[:32] == block.root
    assert sum(r.leaves for r in big if r.tier == 0) == len(members)


def test_a_changed_row_is_found(spark):
    rows = corpus(5, 60)
    paths = M.manifest_of(table(spark, rows))
    wrong = M.folded(paths.withColumn("other", F.unhex(F.sha2("leaf", 256))), "other", "again")
    assert wrong.where("again = root").count() == 0 and M.folded(paths, "leaf", "again").where("again <> root").count() == 0


def test_odd_rows_and_empty_tables(spark):
    assert M.manifest_of(docs(spark, [])).count() == 0
    rows = [(None, None, None, None, None)] * 3 + [(1, "a", "en", 1, "x")] * 4 + [(1, "a", "en", 1, "y"), (None, "a", "en", 2, "z\n")]
    odd = table(spark, rows).selectExpr("*", "1 AS leaf", "2 AS position", "'t' AS tree", "3 AS digest")
    got = sorted([(r.doc_id, r.leaf.hex(), r.folded_root == r.root) for r in M.manifest_of(odd).collect()], key=str)
    assert got == sorted([(w[0], w[1], w[6]) for w in brute_force(rows)], key=str)
