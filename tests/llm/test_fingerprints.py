"""I-Match fingerprints against a plain-Python version of the band and the edits."""

import functools
import hashlib
import operator
import random
import statistics
from collections import Counter

import pytest
import regex
import xxhash
from faultline.llm import fingerprints as P
from tests.llm.helpers import awkward_texts, by_id, docs, prose


def edited(texts):
    out = []
    for i, t in enumerate(texts):
        t, n = t or "", texts[(i + 1) % len(texts)] or ""
        half = len(t) // 2
        out.append(t[:len(t) - half] + n[:half])
    return out


def corpus(n):
    rng = random.Random(1)
    return [prose(rng.randrange(60), rng.choice([5, 40, 120])) for _ in range(n)]


def check_edits(got, ids, texts):
    for i, t, e in zip(ids, texts, edited(texts)):
        assert got[i].n_chars == len(t or "") and got[i].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1


def test_edits_and_equal_texts(spark, monkeypatch):
    monkeypatch.setattr(P, "ROWS_A_RANGE", 6)  # many ranges, so neighbours cross their ends
    texts = awkward_texts() + corpus(60)
    ids = random.Random(2).sample(range(-50, 1000), len(texts))
    ids.sort()
    got = by_id(P.edited_fingerprints(docs(spark, texts, ids=ids).repartition(3)))
    check_edits(got, ids, texts)
    prints = {}
    for i, t in zip(ids, texts):
        assert prints.setdefault(t or "", got[i].fingerprint) == got[i].fingerprint
        if edited(texts)[ids.index(i)] == (t or ""):
            assert got[i].near_edited == 1.0 and got[i].edited_fingerprint == got[i].fingerprint
    same = [i for k, i in enumerate(ids) if (texts[k] or "") == (texts[(k + 1) % len(texts)] or "")]
    assert same and all(got[i].near_next == 1.0 for i in same)
    rows = [got[i] for i in ids]
    assert sum(r.near_edited for r in rows) > sum(r.near_next for r in rows)


def term_hash(word):
    return xxhash.xxh64(word.encode(), seed=42).intdigest() & P.EVERY_TERM


def distinct_terms(text):
    return {term_hash(w) for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w}


def level(held):
    """(hash of all, limit, picks) of a set of term hashes."""
    limit = P.EVERY_TERM
    whole = functools.reduce(operator.xor, held) if held else None
    if len(held) > P.MOST_TERMS:
        limit = 1 << 62
        while sum(h < limit for h in held) > P.MOST_TERMS:
            limit >>= 1
    return whole, limit, {h for h in held if h < limit}


def hashes(side, limit):
    whole, _, picks = side
    out = [whole]
    for k in range(P.SUBSETS):
        mine = [h for h in picks if h < limit and h % P.SUBSETS == k]
        out.append(functools.reduce(operator.xor, mine) if mine else None)
    return out


def brute_force(texts):
    """(fingerprint, edited fingerprint, near_edited, near_next) of each text."""
    texts = [t or "" for t in texts]
    sets = [distinct_terms(t) for t in texts]
    df = Counter(h for s in sets for h in s)
    n = len(texts)
    listed = {h for h, c in df.items() if max(2, P.BAND[0] * n) <= c <= max(2, P.BAND[1] * n)}

    def mark(held):
        known = held & listed
        few = len(known) < P.FEW_TERMS or len(known) < P.FEW_SHARE * len(held)
        return few, level(known), level(held)

    def text_of(m):
        few, known, own = m
        side = own if few else known
        digits = ["" if h is None else f"{h & 0xFFFFFFFF:08x}" for h in hashes(side, side[1])]
        return ("all:" if few else "") + "-".join([str(side[1].bit_length()), *digits])

    def near(a, b):
        few = a[0] or b[0]
        x, y = (a[2], b[2]) if few else (a[1], b[1])
        limit = min(x[1], y[1])
        pairs = [(i, j) for i, j in zip(hashes(x, limit), hashes(y, limit)) if i is not None or j is not None]
        return sum(i == j for i, j in pairs) / len(pairs) if pairs else 1.0

    marks = [mark(s) for s in sets]
    after = [mark(distinct_terms(e)) for e in edited(texts)]
    return [(text_of(m), text_of(e), near(m, e), near(m, marks[(i + 1) % n])) for i, (m, e) in enumerate(zip(marks, after))]


def test_matches_brute_force_at_production_constants(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.sample(words, rng.choice([1, 10, 33, 64, 65, 400, 2000]))) for _ in range(250)] + awkward_texts() + corpus(40)
    got = by_id(P.edited_fingerprints(docs(spark, texts).repartition(4)))
    for i, want in enumerate(brute_force(texts)):
        row = got[i]
        assert (row.fingerprint, row.edited_fingerprint) == want[:2], texts[i]
        assert (row.near_edited, row.near_next) == pytest.approx(want[2:])


def test_half_a_text_that_stays_is_seen_at_every_length(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choice(words) for _ in range(40 * 2 ** (i % 7))) for i in range(210)]
    rows = P.edited_fingerprints(docs(spark, texts)).collect()
    assert sum(r.near_edited > r.near_next for r in rows) >= 0.95 * len(rows)
    assert statistics.median(r.near_edited for r in rows) >= 0.2
    assert statistics.median(r.near_edited for r in rows if r.n_chars > 10000) >= 0.2


def test_lexicon_is_the_band(spark):
    texts = corpus(80)
    words = Counter(w for t in texts for w in set(regex.findall(r"[\p{L}\p{N}]+", t.lower())))
    band = (0.05, 0.4)
    want = {term_hash(w) for w, n in words.items() if band[0] * 80 <= n <= band[1] * 80 and n >= 2}
    got = [r.term for r in P.lexicon_terms(docs(spark, texts), band).collect()]
    assert len(got) == len(want) and set(got) == want
    assert len(want) <= sum(words.values()) / 80 / band[0]  # the bound of the broadcast


def test_hashes_ignore_order_and_terms_outside_the_lexicon(spark):
    lex = P.lexicon_terms(docs(spark, ["alpha beta gamma", "gamma delta alpha"] * 3 + ["x"] * 20), (0.05, 0.9)).cache()
    df = docs(spark, ["alpha beta, gamma!", "GAMMA unseen beta\nalpha alpha", "alpha delta"])
    got = by_id(P.fingerprints(df, ["doc_id"], ["text"], lex))
    assert got[0].text_mark.known == got[1].text_mark.known and len(got[0].text_mark.known.picks) == 3
    assert got[0].text_mark.known != got[2].text_mark.known and got[1].text_mark.own != got[0].text_mark.own


def test_odd_rows_and_empty_tables(spark):
    assert P.edited_fingerprints(docs(spark, [])).count() == 0
    one = P.edited_fingerprints(docs(spark, ["abcd"], ids=[3])).collect()
    assert one[0].near_edited == 0.0 and one[0].near_next == 1.0
    assert one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    empty = P.edited_fingerprints(docs(spark, [None, ""])).collect()
    assert all((r.near_edited, r.near_next, r.n_chars) == (1.0, 1.0, 0) for r in empty)
    texts = ["zz yy", "aa bb", "aa cc", "dd ee"]
    got = P.edited_fingerprints(docs(spark, texts, ids=[None, 4, 4, 9])).collect()  # NULL first, ties by text
    assert sorted(r.edited_sha256 for r in got) == sorted(hashlib.sha256(e.encode()).hexdigest() for e in edited(texts))
    clash = docs(spark, ["a", "b"]).selectExpr("doc_id", "text", "1 AS range", "2 AS row", "3 AS head")
    assert P.edited_fingerprints(clash).count() == 2


def test_plan_has_no_python(spark):
    plan = P.edited_fingerprints(docs(spark, ["a b", "c"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_edits_to_any_lexicon_term_are_seen(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    lex = P.lexicon_terms(docs(spark, [" ".join(rng.sample(words, 6)) for _ in range(200)])).cache()
    assert {r.term for r in lex.collect()} == {term_hash(w) for w in words}
    got = by_id(P.fingerprints(docs(spark, [" ".join(words), *[" ".join(words[:i] + words[i + 1:]) for i in range(60)]]),
                               ["doc_id"], ["text"], lex))
    assert len({r.text_mark.known.whole for r in got.values()}) == 61
    assert not any(r.text_mark.few for r in got.values())


def test_near_copies_of_a_large_group_and_of_a_rare_language_are_alike(spark):
    rng = random.Random(5)
    group = [f"copy{i}" for i in range(40)]
    near = group[:20] + ["changed"] + group[21:]
    rare, rare_near = [f"rare{i}" for i in range(40)], [f"rare{i}" for i in range(39)] + ["other"]
    texts = [" ".join(rng.sample([f"w{i}" for i in range(60)], 25)) for _ in range(600)]
    texts += [" ".join(group)] * 300 + [" ".join(near), " ".join(rare), " ".join(rare_near)]
    got = by_id(P.edited_fingerprints(docs(spark, texts)))
    assert got[899].fingerprint == got[600].fingerprint and got[898].near_next == 1.0
    assert 0.5 < got[899].near_next < 1.0 and 0.5 < got[901].near_next < 1.0
    assert got[900].near_next == 0.0
