"""Near-duplicate groups against all-pairs brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from faultline.llm import frames
from faultline.llm import near_dedup as N
from faultline.llm.components import connected_components
from tests.llm.helpers import WORDS, awkward_texts, by_id, docs, prose


def shingles(text, words):
    import re
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(w) >= words:
        return frozenset(tuple(w[i:i + words]) for i in range(len(w) - words + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute_force(rows, words, percent):
    """{row: (n_shingles, component)} from all pairs."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if find(k) == find(i) and rows[k][0] is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return out


def near_group(seed, size, changes):
    """Copies of one text, each with other words changed, so that copies differ more from each other."""
    rng = random.Random(seed)
    base = prose(seed, 150).split()
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(changes):
            w[rng.randrange(len(w))] = rng.choice(WORDS) + str(rng.randrange(1000))
        out.append(" ".join(w))
    return out


def got_rows(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=str)


def test_groups_match_brute_force(spark):
    texts = awkward_texts() + near_group(1, 30, 2) + near_group(2, 25, 4) + near_group(3, 12, 7) + [prose(1, 40)] * 5
    order = list(range(len(texts)))
    random.Random(5).shuffle(order)
    rows = [(i, texts[k]) for i, k in enumerate(order)]
    df = N.near_duplicates(docs(spark, [t for _, t in rows], ids=[i for i, _ in rows]), words=4)
    assert got_rows(df) == sorted(brute_force(rows, 4, 80), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in df.collect())


def test_odd_ids_and_repeated_rows(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(None, a), (4, a), (4, b), (2, b), (None, c), (None, c), (9, None), (9, ""), (4, a),
            (None, c + " more"), (None, prose(4, 60)), (12, prose(4, 60) + " end")]
    got = got_rows(N.near_duplicates(docs(spark, [t for _, t in rows], ids=[i for i, _ in rows])))
    assert got == sorted(brute_force(rows, 5, 80), key=str)


def test_empty_tables_and_clashing_columns(spark):
    assert N.near_duplicates(docs(spark, [])).count() == 0
    assert N.near_duplicates(docs(spark, [None, "", " "])).where("kept").count() == 3
    clash = docs(spark, ["a b c", "a b c"]).selectExpr("doc_id", "text", "1 AS key", "2 AS kept", "3 AS tie", "4 AS sig", "5 AS _own")
    assert N.near_duplicates(clash).where("kept").count() == 1
    one = N.one_of_each(clash)
    assert one.columns == clash.columns and [r.doc_id for r in one.collect()] == [0]


def test_blocks_split_large_buckets(spark, monkeypatch):
    """Small blocks and wide bands send unlinked documents through many blocks."""
    monkeypatch.setattr(N, "BLOCK_DOCS", 3)
    rows = list(enumerate(near_group(7, 18, 8) + near_group(8, 6, 1)))
    got = got_rows(N.near_duplicates(docs(spark, [t for _, t in rows]), words=4, percent=80))
    assert got == sorted(brute_force(rows, 4, 80), key=str)


def test_every_step_leaves_the_driver_clean(spark, monkeypatch):
    """The driver's garbage goes after each step, and components meet once: the second round knows only their labels."""
    steps, released, met = [], [], []
    write, release, components = frames.written, frames.release_driver, N.connected_components

    def recorded(links):
        out = components(links)
        met.append(({x for r in links.collect() for x in (bytes(r.a), bytes(r.b))}, {bytes(r.node) for r in out.where("node <> label").collect()}))
        return out
    monkeypatch.setattr(frames, "written", lambda df, name: (steps.append(name), write(df, name))[1])
    monkeypatch.setattr(frames, "release_driver", lambda session: (released.append(len(steps)), release(session)))
    monkeypatch.setattr(N, "connected_components", recorded)
    rows = list(enumerate(near_group(7, 18, 8) + near_group(8, 6, 1)))
    kept = N.one_of_each(docs(spark, [t for _, t in rows]), words=4, percent=80)
    assert {r.doc_id for r in kept.collect()} == {d for d, _, c in brute_force(rows, 4, 80) if c == d}
    assert steps[-1] == "near-kept" and released == list(range(1, len(steps) + 1))
    assert len(met) == 2 and met[0][1] and not met[0][1] & met[1][0]


def test_prune_limits_follow_the_posterior():
    limits = N.prune_limits(200, 80, 1e-9, 20)
    rng = np.random.default_rng(0)
    draws = rng.random((2000, 200)) < 0.8  # matches of pairs right at the threshold
    for n, least in limits:
        assert (draws[:, :n].sum(axis=1) >= least).all()
    assert limits[-1][1] > 100  # and pairs far below it go


def test_pairs_at_the_threshold_share_a_band():
    miss = (1 - 0.8 ** N.BAND_ROWS) ** N.BANDS
    assert miss < 1e-6


def test_sets_are_the_same_whatever_the_batch():
    texts = [t for t in awkward_texts()]
    alone = [N.shingle_sets(pa.array([t], pa.string()), 4)[0] for t in texts]
    together = N.shingle_sets(pa.array(texts, pa.string()), 4)
    for t, a, b in zip(texts, alone, together):
        assert np.array_equal(a, b) and len(a) == len(shingles(t, 4))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {x: find(x) for p in links if p[0] != p[1] for x in p}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_regular_words_are_told_apart(spark):
    words = []
    for size in (1024, 4096):
        bits = [bin(i).count("1") % 2 for i in range(size)]
        words += ["".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)]
    texts = [f"one two three four {w}" for w in words]
    got = by_id(N.near_duplicates(docs(spark, texts), words=4, percent=60))
    assert [got[i].component_id for i in range(4)] == [0, 1, 2, 3]
    assert len({N.shingle_sets(pa.array([t]), 4)[0].tobytes() for t in texts}) == 4
