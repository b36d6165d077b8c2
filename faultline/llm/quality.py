"""Document quality by attention-based multiple-instance learning (operator 2).

A document is a bag of passages; only the document has a label.  Every passage
is encoded from the kinds of its characters and the make-up of its words,
gated attention learned from the document labels weighs the passages, and the
weighted passage representation is scored.  Trained in numpy on a bounded
sample of labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrays import SpanHasher, ascii_words, doc_slices, utf8_column
from .frames import add_columns

PASSAGE_WORDS = 48
HIDDEN, ATTENTION = 24, 12
PER_LABEL = (2000, 2000)  # documents of labels 0 and 1 trained on, at most
TRAIN_BYTES = 32_768    # of each, at most
EPOCHS = 30

# kinds of bytes: lower, upper, digit, space, line break, sentence mark, quote or bracket, other symbol, non-ASCII
KINDS = 9
_KIND = np.full(256, 7, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[[32, 9]], _KIND[[10, 11, 12, 13]], _KIND[128:] = 3, 4, 8
_KIND[[ord(c) for c in ".,;:?"]] = 5
_KIND[[ord(c) for c in "'\"()[]{}"]] = 6
LAGS = (1, 2, 3, 4)
FEATURES = KINDS * KINDS + len(LAGS) + 4


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, passages per document) of a run of documents.

    A passage is ``PASSAGE_WORDS`` words with the white space after them; a
    document without words is one passage without features.
    """
    starts, ends, words = ascii_words(data, offsets)
    docs = len(words)
    count = np.maximum(1, -(-words // PASSAGE_WORDS))
    first_word = np.cumsum(words) - words
    doc = np.repeat(np.arange(docs), count)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    out = np.zeros((len(doc), FEATURES), np.float32)
    if not len(starts):
        return out, count
    word_doc = np.repeat(np.arange(docs), words)
    word_at = np.arange(len(starts)) - first_word[word_doc]
    base = np.cumsum(count) - count
    passage = base[word_doc] + word_at // PASSAGE_WORDS
    # bytes belong to the passage of the last word that starts before them
    owner = np.searchsorted(starts, np.arange(len(data)), side="right") - 1
    byte_passage = passage[np.maximum(owner, 0)]
    byte_doc = np.repeat(np.arange(docs), np.diff(offsets))
    byte_passage = np.where((owner >= 0) & (doc[byte_passage] == byte_doc), byte_passage, base[byte_doc])
    kind = _KIND[data].astype(np.int64)
    pair = np.flatnonzero(byte_passage[1:] == byte_passage[:-1])
    table = np.bincount(byte_passage[pair] * (KINDS * KINDS) + kind[pair] * KINDS + kind[pair + 1],
                        minlength=len(doc) * KINDS * KINDS).reshape(len(doc), -1)
    out[:, :KINDS * KINDS] = np.sqrt(table / np.maximum(1, table.sum(axis=1, keepdims=True)))
    held = np.bincount(passage, minlength=len(doc))
    some = np.maximum(1, held)
    words_hash = SpanHasher(data).spans(starts, ends)
    at = KINDS * KINDS
    for k, lag in enumerate(LAGS):
        same = (words_hash[lag:] == words_hash[:-lag]) & (passage[lag:] == passage[:-lag])
        out[:, at + k] = np.bincount(passage[lag:], same, minlength=len(doc)) / some
    size = (ends - starts).astype(np.float64)
    mean = np.bincount(passage, size, minlength=len(doc)) / some
    out[:, at + len(LAGS)] = mean / 10
    out[:, at + len(LAGS) + 1] = np.sqrt(np.maximum(0, np.bincount(passage, size ** 2, minlength=len(doc)) / some - mean ** 2)) / 10
    out[:, at + len(LAGS) + 2] = held / PASSAGE_WORDS
    out[:, at + len(LAGS) + 3] = np.log1p(words[doc]) / 10
    out[base[words == 0]] = 0
    return out, count


@dataclass
class Model:
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, count: np.ndarray):
        w = self.w
        h = np.tanh(((x - w["mean"]) / w["scale"]) @ w["enc"] + w["enc_b"])
        t, g = np.tanh(h @ w["att"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        raw = (t * g) @ w["att_w"]
        first = np.cumsum(count) - count
        top = np.maximum.reduceat(raw, first)
        weight = np.exp(raw - np.repeat(top, count))
        weight /= np.repeat(np.add.reduceat(weight, first), count)
        z = np.add.reduceat(weight[:, None] * h, first, axis=0)
        return h, t, g, weight, z, z @ w["out"] + w["out_b"]

    def scores(self, column: pa.Array) -> np.ndarray:
        data, offsets = utf8_column(column)
        out = np.zeros(len(offsets) - 1)
        for i, j in doc_slices(offsets):
            x, count = passages(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            out[i:j] = 1 / (1 + np.exp(-np.clip(self.forward(x, count)[-1], -60, 60)))
        return out


def _blank(rng) -> dict[str, np.ndarray]:
    def draw(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    return {"mean": np.zeros(FEATURES, np.float32), "scale": np.ones(FEATURES, np.float32),
            "enc": draw(FEATURES, HIDDEN), "enc_b": np.zeros(HIDDEN, np.float32), "att": draw(HIDDEN, ATTENTION),
            "gate": draw(HIDDEN, ATTENTION), "att_w": draw(ATTENTION), "out": draw(HIDDEN),
            "out_b": np.zeros((), np.float32)}


def train(sample: list[tuple[str, int]], seed: int = 3) -> Model:
    """Adam on the documents' labels, mini-batches of whole documents.

    Each label weighs as it occurs in the sample.  Without both labels the
    score is the constant share of label 1 (0.5 for an empty sample).
    """
    rng = np.random.default_rng(seed)
    model = Model(_blank(rng))
    w = model.w
    labels = np.array([y for _, y in sample], np.float32)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
        w["out"][:] = 0
        w["out_b"] = np.float32(np.log(share / (1 - share)))
        return model
    data, offsets = utf8_column(pa.array([t for t, _ in sample], pa.string()))
    parts = [passages(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in doc_slices(offsets)]
    x, count = (np.concatenate(p) for p in zip(*parts))
    w["mean"], w["scale"] = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    first = np.cumsum(count) - count
    learned = [k for k in w if k not in ("mean", "scale")]
    m = {k: np.zeros_like(w[k]) for k in learned}
    v = {k: np.zeros_like(w[k]) for k in learned}
    turn = 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS) + 1e-4
        order = rng.permutation(len(sample))
        for lo in range(0, len(order), 64):
            mine = order[lo:lo + 64]
            rows = np.concatenate([np.arange(first[d], first[d] + count[d]) for d in mine])
            xb, cb, yb = x[rows], count[mine], labels[mine]
            h, t, g, a, z, logit = model.forward(xb, cb)
            d_logit = (1 / (1 + np.exp(-logit)) - yb) / len(mine)
            grad = {"out": z.T @ d_logit, "out_b": d_logit.sum()}
            d_z = np.repeat(d_logit[:, None] * w["out"][None, :], cb, axis=0)
            d_a = (d_z * h).sum(axis=1)
            f = np.cumsum(cb) - cb
            d_raw = a * (d_a - np.repeat(np.add.reduceat(a * d_a, f), cb))
            grad["att_w"] = (t * g).T @ d_raw
            d_tg = d_raw[:, None] * w["att_w"][None, :]
            d_t, d_g = d_tg * g * (1 - t ** 2), d_tg * t * g * (1 - g)
            grad["att"], grad["gate"] = h.T @ d_t, h.T @ d_g
            d_h = a[:, None] * d_z + d_t @ w["att"].T + d_g @ w["gate"].T
            d_pre = d_h * (1 - h ** 2)
            grad["enc"], grad["enc_b"] = ((xb - w["mean"]) / w["scale"]).T @ d_pre, d_pre.sum(axis=0)
            turn += 1
            for k in learned:
                gk = grad[k] + 1e-4 * w[k]
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.99 * v[k] + 0.01 * gk ** 2
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** turn)) / (np.sqrt(v[k] / (1 - 0.99 ** turn)) + 1e-8)).astype(np.float32)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for every whole text.

    NULL, empty and blank texts are one passage without words and get its
    score.  Rows are independent: repeated rows and ids are scored each, an
    empty table gives an empty one, a column named ``out`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers
    return add_columns(docs, [T.StructField(out, T.DoubleType())], lambda b: [
        pa.array(sent.value.scores(b.column(b.schema.get_field_index(text_col))).astype(np.float64))])
