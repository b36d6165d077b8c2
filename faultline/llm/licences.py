"""License scans: notice phrases and identifier tags (operator 11).

One Aho-Corasick automaton finds every place of every notice phrase in the
words of a whole text; a second finds the identifier tags in the text itself.
The licence expression after a tag is read by a shunting-yard parser (WITH
binds before AND, AND before OR, parentheses group) and evaluated to the terms
that the reader may choose: OR takes the mildest side, AND the strictest, and
an exception turns strong copyleft into weak.

Texts are scanned in slices of a few hundred kilobytes with array operations;
Python touches only the places found.  No shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import doc_slices, remembered, utf8_column
from .frames import add_columns

# Phrase, label, weight.  The first three are the base.
BASE = (
    ("mit license", "mit", 0.6),
    ("apache license", "apache", 0.6),
    ("general public license", "gpl", 0.6),
)
NOTICES = (
    ("affero general public license", "agpl", 0.6),
    ("lesser general public license", "lgpl", 0.6),
    ("library general public license", "lgpl", 0.6),
    ("general public license version 2", "gpl-2.0", 0.7),
    ("general public license version 3", "gpl-3.0", 0.7),
    ("apache license version 2 0", "apache-2.0", 0.7),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit-text", 0.9),
    ("redistribution and use in source and binary forms", "bsd-text", 0.9),
    ("bsd license", "bsd", 0.6),
    ("isc license", "isc", 0.6),
    ("mozilla public license", "mpl", 0.6),
    ("eclipse public license", "epl", 0.6),
    ("creative commons", "cc", 0.4),
    ("licensed under cc by", "cc-by", 0.7),
    ("licensed under cc by nc", "cc-by-nc", 0.7),
    ("licensed under cc by sa", "cc-by-sa", 0.7),
    ("released into the public domain", "public-domain", 0.6),
    ("all rights reserved", "proprietary", 0.3),
)
TAGS = ("spdx-license-identifier:", "license-expression:")
TAG_WEIGHT = 0.95  # of each licence named by a valid tag
# Terms from mild to strict, and the beginnings of the licence ids that have them.
TERMS = ("permissive", "weak-copyleft", "strong-copyleft", "other")
FAMILIES = {
    "permissive": ("mit", "isc", "bsd", "apache", "zlib", "unlicense", "cc0", "0bsd", "boost", "bsl-1.0", "python", "psf",
                   "cc-by-1", "cc-by-2", "cc-by-3", "cc-by-4"),
    "weak-copyleft": ("lgpl", "mpl", "epl", "cddl", "eupl"),
    "strong-copyleft": ("gpl", "agpl", "osl", "cc-by-sa"),
}
RANKS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[ \t]*([()]|[a-z0-9][a-z0-9.+:-]*)")

PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType()),
                      T.StructField("base", T.BooleanType()), T.StructField("weight", T.DoubleType())])
TAG = T.StructType([T.StructField("expression", T.StringType()), T.StructField("ids", T.ArrayType(T.StringType())),
                    T.StructField("terms", T.StringType())])
ARROW_PLACE = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("base", pa.bool_()), ("weight", pa.float64())]))
ARROW_TAG = pa.list_(pa.struct([("expression", pa.string()), ("ids", pa.list_(pa.string())), ("terms", pa.string())]))

_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0"):ord("9") + 1] = _IN_WORD[ord("A"):ord("Z") + 1] = _IN_WORD[ord("a"):ord("z") + 1] = _IN_WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def read_tokens(text: str, at: int = 0, end: int | None = None) -> list[str]:
    """The tokens of text[at:end] as far as they can belong to one expression
    on one line: operands and operators take turns."""
    out, operand, depth = [], True, 0
    while found := TOKEN.match(text, at, len(text) if end is None else end):
        token = found.group(1)
        if operand:
            if token in RANKS or token == ")":
                break
            depth += token == "("
            operand = token == "("
        else:
            if token == ")":
                if not depth:
                    break
                depth -= 1
            elif token in RANKS:
                operand = True
            else:
                break
        out.append(token)
        at = found.end()
    return out


def postfix(tokens: Iterable[str]) -> list[str] | None:
    """Shunting-yard: ``tokens`` in postfix order, or None if they are no
    whole expression."""
    out, waiting, operand = [], [], True
    for token in tokens:
        if token == "(" and operand:
            waiting.append(token)
        elif token == ")" and not operand:
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif token in RANKS and not operand:
            while waiting and waiting[-1] != "(" and RANKS[waiting[-1]] >= RANKS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = True
        elif token not in RANKS and token not in "()" and operand:
            out.append(token)
            operand = False
        else:
            return None
    if operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def licence_terms(licence: str) -> str:
    return next((t for t in TERMS[:-1] if licence.startswith(FAMILIES[t])), TERMS[-1])


def evaluate(tokens: Iterable[str]) -> tuple[list[str], str] | None:
    """(licence ids, terms) of an expression; None if it is not valid.

    An id with an exception is ``id-with-exception``.  OR has the mildest of
    its sides' terms, AND the strictest, an exception makes strong copyleft weak.
    """
    order = postfix(tokens)
    if order is None:
        return None
    stack: list[tuple[set, int, bool]] = []  # ids, index of the terms, one plain id
    for token in order:
        if token not in RANKS:
            stack.append(({token}, TERMS.index(licence_terms(token)), True))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            if not (left[2] and right[2]):
                return None
            (name,), (exception,) = left[0], right[0]
            stack.append(({f"{name}-with-{exception}"}, 1 if left[1] == 2 else left[1], False))
        else:
            stack.append((left[0] | right[0], (min if token == "or" else max)(left[1], right[1]), False))
    ids, terms, _ = stack.pop()
    return sorted(ids), TERMS[terms]


def _automaton(keys: Iterable[str]):
    found = ahocorasick.Automaton()
    for i, key in enumerate(keys):
        found.add_word(key, (i, len(key)))
    found.make_automaton()
    return found


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[str, np.ndarray, np.ndarray]:
    """(one string of all words in lower case, a space before and after each;
    where each begins there; index of each document's first word)."""
    solid = _IN_WORD[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = solid[heads]  # a document ends the word before it
    at = np.flatnonzero(solid)
    where = np.arange(len(at)) + np.cumsum(first[at])  # one space before each word
    starts = np.flatnonzero(first)
    out = np.full((int(where[-1]) if len(where) else 0) + 2, 32, np.uint8)
    out[where] = _LOWER[data[at]]
    return out.tobytes().decode("latin-1"), where[np.searchsorted(at, starts)], np.searchsorted(starts, offsets)


def _scan(column: pa.Array, phrases: tuple) -> list[pa.Array]:
    """n_words, places and tags of each text."""
    notices = remembered(("licence phrases", phrases), lambda: _automaton(f" {p} " for p, *_ in phrases))
    tag_names = remembered(("licence tags", TAGS), lambda: _automaton(TAGS))
    data, offsets = utf8_column(column)
    n = len(offsets) - 1
    counts = np.zeros(n, np.int64)
    places, tags = [[] for _ in range(n)], [[] for _ in range(n)]
    for i, j in doc_slices(offsets):
        part, ends = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        text, word_at, doc_word = _words(part, ends)
        counts[i:j] = np.diff(doc_word)
        found = [(end - length + 2, k) for end, (k, length) in notices.iter(text)]
        if found:
            word = np.searchsorted(word_at, [f[0] for f in found])
            doc = np.searchsorted(doc_word, word, side="right") - 1
            for w, d, (_, k) in zip(word.tolist(), doc.tolist(), found):
                phrase, label, weight = phrases[k]
                if w + phrase.count(" ") < doc_word[d + 1]:  # not across two documents
                    places[i + d].append((w - int(doc_word[d]), label, k < len(BASE), weight))
        raw = _LOWER[part].tobytes().decode("latin-1")
        for end, (_, length) in tag_names.iter(raw):
            d = int(np.searchsorted(ends, end - length + 1, side="right")) - 1
            if end < ends[d + 1]:
                tokens = read_tokens(raw, end + 1, int(ends[d + 1]))
                value = evaluate(tokens)
                tags[i + d].append({"expression": " ".join(tokens), "ids": value[0] if value else [],
                                    "terms": value[1] if value else None})
    rows = [[{"label": label, "word": w, "base": base, "weight": weight} for w, label, base, weight in sorted(p)] for p in places]
    return [pa.array(counts), pa.array(rows, ARROW_PLACE), pa.array(tags, ARROW_TAG)]


def scan_licences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, places, tags, labels and score of every whole text.

    ``places``: label, word (its first word, from 0), base and weight of every
    occurrence of a phrase whose words stand consecutively, in order; phrases
    may overlap.  Words are runs of ASCII digits, letters (A-Z lower-cased) and
    non-ASCII characters.  ``tags``: the expression after every identifier tag
    as far as it can be read on that line, its licence ids and terms; an
    expression that is not whole has no ids and NULL terms.  ``labels``: the
    distinct labels of the places, ``spdx:<id>`` and ``terms:<terms>`` of valid
    tags, in code point order.  ``score`` is 1 - product(1 - weight) over the
    distinct labels of places and ids: 0 without any.

    NULL and empty texts have no words and no labels.  Repeated rows are
    scanned each; an empty table gives an empty one; columns of the new names
    are replaced, others kept.
    """
    phrases = BASE + NOTICES
    fields = [T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(PLACE)),
              T.StructField("tags", T.ArrayType(TAG))]
    found = add_columns(docs.drop("labels", "score"), fields,
                        lambda b: _scan(b.column(b.schema.get_field_index(text_col)), phrases))
    valid = F.filter("tags", lambda t: t["terms"].isNotNull())
    ids = F.array_distinct(F.flatten(F.transform(valid, lambda t: t["ids"])))
    spdx = F.transform(ids, lambda i: F.concat(F.lit("spdx:"), i))
    terms = F.transform(valid, lambda t: F.concat(F.lit("terms:"), t["terms"]))
    weighed = F.array_distinct(F.transform("places", lambda p: F.struct(p["label"], p["weight"])))
    doubt = F.aggregate(weighed, F.lit(1.0), lambda left, w: left * (F.lit(1.0) - w["weight"]))
    return (found.withColumn("labels", F.array_sort(F.array_distinct(F.concat(
                F.transform("places", lambda p: p["label"]), spdx, terms))))
            .withColumn("score", F.lit(1.0) - doubt * F.pow(F.lit(1 - TAG_WEIGHT), F.size(ids))))


def base_places(places: str = "places") -> Column:
    """First words of the places of base phrases."""
    return F.transform(F.filter(places, lambda p: p["base"]), lambda p: p["word"])


def base_labels(places: str = "places") -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(places, lambda p: p["base"]), lambda p: p["label"])))
