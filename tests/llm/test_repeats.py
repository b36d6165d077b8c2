"""Repeat removal against every window of every document."""

import hashlib
import random

import numpy as np
import pytest

from faultline.llm import frames
from faultline.llm import repeats as R
from tests.llm.helpers import awkward_texts, docs, prose, shuffle_files


def brute_force(rows, length):
    """(id, bytes, removed, runs, kept) of every row; a NULL id is the largest."""
    first = {}
    key = [R.NO_ID if i is None else i for i, _ in rows]
    raws = [(t or "").encode() for _, t in rows]
    for i, raw in zip(key, raws):
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for (d, _), i, raw in zip(rows, key, raws):
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if first[raw[s:s + length]] < i:
                gone[s:s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((d, len(raw), sum(gone), len([r for r in bytes(gone).split(b"\0") if r]), kept))
    return out


def check(spark, rows, length=50):
    got = R.remove_repeats(docs(spark, [t for _, t in rows], ids=[i for i, _ in rows]), length)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()]
    assert sorted(got, key=str) == sorted(brute_force(rows, length), key=str)


def passages(seed, n):
    """Documents that share passages of 30 to 300 characters at any place, some cut in the middle."""
    rng = random.Random(seed)
    pool = [prose(100 + seed * 10 + k, 60) for k in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(pool)
            a = rng.randrange(0, len(p) // 2)
            parts += [prose(rng.randrange(10 ** 6), rng.randint(0, 12)), p[a:a + rng.randint(30, 300)]]
        out.append(rng.choice(["", " ", "é"]).join(parts))
    return out


def test_awkward_texts(spark):
    texts = awkward_texts()
    check(spark, list(enumerate(texts + texts[::-1])))


@pytest.mark.parametrize("length", [50, 33])
def test_shared_passages(spark, length):
    check(spark, list(enumerate(passages(length, 60))), length)


def test_periodic_texts(spark):
    check(spark, list(enumerate(["ab" * 60, "x" + "ab" * 40 + "y", "b" + "ab" * 30, "abc" * 50, "c" + "abc" * 20, "a" * 300, "a" * 49, "a" * 50])))


def test_odd_ids_and_repeated_rows(spark):
    a, b = prose(1, 40), prose(2, 40)
    check(spark, [(None, a), (3, a + b), (3, b), (3, a + b), (1, b), (None, b), (None, a), (7, None), (7, "")])


def test_hot_anchors_are_dealt_by_longer_content(spark, monkeypatch):
    monkeypatch.setattr(R, "HOT_LEAST", 5)
    rng = random.Random(3)
    shared = prose(77, 30)
    texts = [prose(rng.randrange(10 ** 6), 6)[rng.randrange(5):] + shared[rng.randrange(20):] + prose(rng.randrange(10 ** 6), 5)
             for _ in range(60)]
    check(spark, list(enumerate(texts)))


def test_small_parts_and_flushes(spark, monkeypatch):
    for name, value in (("FLUSH", 40), ("ANCHORS_A_PART", 64), ("CHUNK", 8)):
        monkeypatch.setattr(R, name, value)
    check(spark, list(enumerate(passages(9, 40))))


def test_empty_table_clashing_columns_and_texts(spark):
    assert R.remove_repeats(docs(spark, [])).count() == 0
    a = "é" * 40 + prose(1, 30)
    clash = docs(spark, [a, "ü" + a[1:] + "!", None]).selectExpr(
        "doc_id", "text", "1 AS doc", "2 AS raw", "3 AS kept", "4 AS spans", "5 AS mark", "6 AS n_bytes", "7 AS `_0`", "8 AS `a b`")
    got = {r.doc_id: r for r in R.remove_repeats(clash).collect()}
    assert got[0].n_removed == 0 and got[0].doc == 1 and got[0]["a b"] == 8
    texts = {r.doc_id: r for r in R.remove_repeated_text(clash.drop("kept", "n_bytes")).collect()}
    assert texts[0].text == a and texts[1].text == "ü!" and texts[2].text == "" and texts[1]._0 == 7


def test_maximal_repeats_are_groups_of_all_occurrences():
    words = [b"XXhello world, this is one passageAA", b"YYhello world, this is one passageBB",
             b"ZZhello world, this is one passageAA", b"nothing of the kind stands in here"]
    rows = np.zeros((4, 40), np.uint8)
    sizes = np.array([len(w) for w in words])
    for i, w in enumerate(words):
        rows[i, :len(w)] = np.frombuffer(w, np.uint8)
    segment, start, common = R.suffix_array(rows, sizes, 20)
    suffixes = [words[s][a:] for s, a in zip(segment, start)]
    assert suffixes == sorted(suffixes) and len(suffixes) == sum(max(0, len(w) - 19) for w in words)
    before = np.where(start > 0, rows[segment, np.maximum(start - 1, 0)].astype(int), -1)
    groups = {(suffixes[lo][:n], frozenset(segment[lo:hi + 1].tolist())) for lo, hi, n in R.maximal_repeats(common, before, 20)}
    assert groups == {(b"hello world, this is one passage", frozenset([0, 1, 2])),
                      (b"hello world, this is one passageAA", frozenset([0, 2]))}


def test_spans_merge_into_maximal_runs():
    a, b = R.merge_spans(np.array([5, 0, 10, 30]), np.array([10, 3, 12, 40]))
    assert (a.tolist(), b.tolist()) == ([0, 5, 30], [3, 12, 40])


def test_query_digest(spark, tmp_path):
    from faultline.llm.queries import QUERIES
    texts = passages(4, 20)
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op5_repeats"](spark, str(tmp_path)).collect()}
    for d, n, gone, runs, kept in brute_force(list(enumerate(texts)), 50):
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans) == (n, gone, runs)
        assert got[d].kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_steps_leave_no_shuffle_files(spark, monkeypatch):
    """Each step's shuffle files go as it ends, not once the driver collects garbage."""
    monkeypatch.setattr(frames, "release_driver", lambda spark: None)
    setting, plain, left = spark.conf.get(frames.SHUFFLES_GO), R.written_step, {}

    def step(df, name):
        before = shuffle_files(spark)
        out = plain(df, name)
        left[name] = shuffle_files(spark) - before
        return out
    monkeypatch.setattr(R, "written_step", step)
    rows = list(enumerate(passages(11, 30)))
    check(spark, rows)
    assert left == {"repeat-texts": set(), "repeat-anchors": set(), "repeat-spans": set()}
    assert spark.conf.get(frames.SHUFFLES_GO) == setting
