"""License scans against a plain-Python scan; the expression parser against a recursive one."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faultline.llm import licences as L
from faultline.llm import queries as Q
from tests.llm.helpers import awkward_texts, by_id, docs, prose

TEXTS = awkward_texts() + [
    "Released under the MIT License.", "mit-license\nMIT  LICENSE mit license", "mit", "license mit", "MITLicense", "é mit license",
    "ends with MIT", "License begins", "GNU Affero General Public License, Version 3, Apache License, Version 2.0.",
    "// SPDX-License-Identifier: MIT OR (Apache-2.0 AND GPL-2.0+ WITH Classpath-exception-2.0) the rest",
    "SPDX-License-Identifier: MIT OR\nSPDX-License-Identifier: (MIT\nSPDX-License-Identifier:", "license-expression: LGPL-2.1-only",
    "SPDX-License-Identifier: " + "(" * 5000, prose(1, 5000) + " general public\n\nlicense " + prose(2, 5000),
    "mit license " * 3000, "Licensed under CC BY-NC 4.0."]


def brute_force(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = sorted((i, label, k < len(L.BASE)) for k, (phrase, label, _) in enumerate(L.BASE + L.NOTICES)
                    for i in range(len(words)) if words[i:i + phrase.count(" ") + 1] == phrase.split())
    return len(words), places


def test_places_match_brute_force(spark):
    got = by_id(L.scan_licences(docs(spark, TEXTS).repartition(3)))
    for i, text in enumerate(TEXTS):
        n, places = brute_force(text)
        assert (got[i].n_words, [(p.word, p.label, p.base) for p in got[i].places]) == (n, places), text
        assert {label for _, label, _ in places} == {x for x in got[i].labels if ":" not in x}


def test_contract_columns(spark, tmp_path):
    docs(spark, TEXTS).write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(Q.QUERIES["op11_licences"](spark, str(tmp_path)))
    for i, text in enumerate(TEXTS):
        base = [(w, label) for w, label, base in brute_force(text)[1] if base]
        row = got[i]
        assert (row.n_base, row.first_word, row.last_word) == (
            len(base), min((w for w, _ in base), default=None), max((w for w, _ in base), default=None))
        assert row.base_labels == ",".join(sorted({label for _, label in base}))
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(",")) and 0 <= row.score <= 1
        assert (row.score > 0) == any(not x.startswith("terms:") for x in row.labels.split(",") if x)
    tag = next(i for i, t in enumerate(TEXTS) if t and t.startswith("// SPDX"))
    assert got[tag].labels == ("spdx:apache-2.0,spdx:gpl-2.0+-with-classpath-exception-2.0,spdx:mit,terms:permissive")
    assert got[tag].score == pytest.approx(1 - 0.05 ** 3)


def test_tags_and_their_documents(spark):
    got = by_id(L.scan_licences(docs(spark, TEXTS)))
    broken = next(i for i, t in enumerate(TEXTS) if t and t.startswith("SPDX-License-Identifier: MIT OR\n"))
    assert [(t.expression, t.ids, t.terms) for t in got[broken].tags] == [("mit or", [], None), ("( mit", [], None), ("", [], None)]
    assert got[broken + 1].tags[0].terms == "weak-copyleft" and got[broken + 2].tags[0].terms is None
    assert got[0].tags == [] and got[0].labels == [] and got[0].score == 0.0


IDS = {"mit": 0, "lgpl-2.1": 1, "gpl-3.0": 2, "unheard-of": 3}
expressions = st.recursive(
    st.sampled_from(sorted(IDS)), lambda e: st.tuples(e, st.sampled_from(["and", "or"]), e) | st.tuples(st.sampled_from(sorted(IDS)), st.just("with"), st.just("some-exception")),
    max_leaves=12)


def written_out(e, outer=0):
    """(text with no more parentheses than needed, ids, terms)"""
    if isinstance(e, str):
        return e, {e}, IDS[e]
    if e[1] == "with":
        return " ".join(e), {f"{e[0]}-with-{e[2]}"}, 1 if IDS[e[0]] == 2 else IDS[e[0]]
    rank = L.RANKS[e[1]]
    (left, a, x), (right, b, y) = written_out(e[0], rank), written_out(e[2], rank + 1)
    text = f"{left} {e[1]} {right}"
    return f"({text})" if rank < outer else text, a | b, (min if e[1] == "or" else max)(x, y)


@settings(max_examples=200, deadline=None)
@given(expressions)
def test_shunting_yard_matches_the_tree(e):
    text, ids, terms = written_out(e)
    assert L.evaluate(L.read_tokens(text)) == (sorted(ids), L.TERMS[terms])


@pytest.mark.parametrize("text", ["", "and", "mit or", "(mit", "mit with", "(mit or isc) with x", "()"])
def test_invalid_expressions(text):
    assert L.evaluate(L.read_tokens(text)) is None


def test_odd_rows_and_empty_tables(spark):
    assert L.scan_licences(docs(spark, [])).count() == 0
    odd = docs(spark, ["mit license", "mit license", None], ids=[None, None, None]).selectExpr("*", "1 AS places", "'x' AS Score", "2 AS word")
    got = L.scan_licences(odd)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "word", "n_words", "places", "tags", "labels", "score"]
    assert sorted(r.n_words for r in got.collect()) == [0, 2, 2]
