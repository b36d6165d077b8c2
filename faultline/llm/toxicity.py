"""Toxicity by averaged subword embeddings and a linear softmax (operator 10).

A text is the bag of its words' character n-grams (word ends marked), hashed
into buckets; a document's vector is the mean of its buckets' embeddings, and
a softmax over two classes reads it.  Embeddings and softmax are trained
together in numpy on a bounded sample of labelled documents of every length,
in one task; its n-grams are counted by many.  A word never
seen shares n-grams, so vectors, with the words it was misspelt from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import SpanHasher, doc_slices, lower_ascii, utf8_column
from .frames import add_columns, release_memory, small_batches, written_step

SIZES = (3, 4, 5)       # bytes of the n-grams
BUCKET_BITS = 18
SLICE_BYTES = 1 << 18   # of text scored together
DIMENSIONS = 8
PER_LABEL = (8000, 2000)  # documents of labels 0 and 1 trained on, at most
TRAIN_BYTES = (16_000_000, 4_000_000)  # of the documents of labels 0 and 1 together, at most;
LONGEST_BYTES = (1 << BUCKET_BITS) // len(SIZES)  # a longer one counts as this: it has no more distinct n-grams
STEPS = 40_000          # documents seen in training, repeats counted: 4 passes and more, at most 40
DECAY = 0.05            # pull of a document's own subwords towards zero, so rare ones stay small


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every n-gram inside a word with its end marks.

    Each document's bytes are set between spaces, white space is one kind of
    space and A-Z are lower-cased; an n-gram holds no inner space.
    """
    docs = len(offsets) - 1
    size = len(data) + docs + 1
    text = np.full(size, 32, np.uint8)
    shift = np.repeat(np.arange(1, docs + 1), np.diff(offsets))
    text[np.arange(len(data)) + shift] = lower_ascii(data)
    text[(text >= 9) & (text <= 13)] = 32
    spaces = np.concatenate([[0], np.cumsum(text == 32)])
    starts = offsets[:-1] + np.arange(docs)  # the space before each document
    hasher = SpanHasher(text)
    buckets, owners = [], []
    for n in SIZES:
        h = hasher.windows(n)
        m = len(h)
        inner = spaces[n - 1:n - 1 + m] - spaces[1:1 + m]
        at = np.flatnonzero((inner == 0))
        buckets.append(((h[at] ^ np.uint64(n)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
        owners.append((np.searchsorted(starts, at, side="right") - 1).astype(np.int32))
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Model:
    weight: np.ndarray  # each bucket's embedding through the softmax: logit of label 1 against 0
    bias: float

    def logits(self, column: pa.Array) -> np.ndarray:
        data, offsets = utf8_column(column)
        out = np.full(len(offsets) - 1, self.bias)
        for i, j in doc_slices(offsets, SLICE_BYTES):
            bucket, owner = subwords(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            total = np.bincount(owner, self.weight[bucket], minlength=j - i)
            out[i:j] += total / np.maximum(1, np.bincount(owner, minlength=j - i))
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(column), -60, 60)))


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, share of each) of a text's n-grams, at most 2 ** BUCKET_BITS of them."""
    data, offsets = utf8_column(pa.array([text], pa.string()))
    bucket, count = np.unique(subwords(data, offsets)[0], return_counts=True)
    return bucket, (count / max(1, count.sum())).astype(np.float32)


def sampled_bags(sample: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, label and the bag (the bytes of its two arrays) of every row of ``sample`` (text, label)."""
    def batches(it):
        for batch in (small for whole in it for small in small_batches(whole)):
            bags = [bag(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([b.tobytes() for b, _ in bags], pa.binary()),
                 pa.array([s.tobytes() for _, s in bags], pa.binary())], names=["id", "label", "bucket", "share"])
            del bags
            release_memory()

    rows = (sample.select(F.col(id_col).cast("long").alias("id"), F.col("label").cast("int").alias("label"), "text")
            .mapInArrow(batches, "id long, label int, bucket binary, share binary"))
    return written_step(rows, "toxicity-sample")


def train_sampled(bags: DataFrame) -> Model:
    """``train_bags`` on ``sampled_bags``, in the order of the ids.

    The training is one task, as its steps follow each other; the sample is
    bounded, and the driver gets the model alone: 2 ** BUCKET_BITS floats.
    """
    def fit(it):
        got = [(i, np.frombuffer(b, np.int32), np.frombuffer(s, np.float32), y)
               for batch in it for i, y, b, s in zip(*(batch.column(n).to_pylist() for n in ("id", "label", "bucket", "share")))]
        if got:
            model = train_bags([((bucket, share), y) for _, bucket, share, y in sorted(got, key=lambda g: g[0])])
            del got
            yield pa.RecordBatch.from_pydict({"weight": pa.array([model.weight.tobytes()], pa.binary()),
                                              "bias": pa.array([model.bias], pa.float64())})
        release_memory()

    made = bags.coalesce(1).mapInArrow(fit, "weight binary, bias double").collect()
    return Model(np.frombuffer(bytes(made[0]["weight"]), np.float32), made[0]["bias"]) if made else train_bags([])


def train(sample: list[tuple[str, int]], seed: int = 1) -> Model:
    """``train_bags`` on (text, label) pairs."""
    return train_bags([(bag(text), label) for text, label in sample], seed)


def train_bags(sample: list[tuple[tuple[np.ndarray, np.ndarray], int]], seed: int = 1) -> Model:
    """Joint training by stochastic gradient descent with per-value steps.

    Every sampled document weighs the same, so label 0 has a prior as it is
    in the sample.  Without both labels the model is the constant share of label 1 (0.5 and no
    evidence for an empty sample).
    """
    labels = np.array([y for _, y in sample], np.int64)
    if len(set(labels.tolist())) < 2:
        share = (labels.sum() + 1) / (len(labels) + 2) if len(labels) else 0.5
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    embed = (rng.standard_normal((1 << BUCKET_BITS, DIMENSIONS)) * 0.1).astype(np.float32)
    soft = (rng.standard_normal((DIMENSIONS, 2)) * 0.1).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_e = np.full((1 << BUCKET_BITS, 1), 1e-8, np.float32)
    seen_s, seen_b = np.full((DIMENSIONS, 2), 1e-8, np.float32), np.full(2, 1e-8, np.float32)
    epochs = min(40, max(4, STEPS // len(sample)))
    for epoch in range(epochs):
        step = np.float32(0.3 * (1 - epoch / epochs))
        for d in rng.permutation(len(sample)):
            bucket, share = sample[d][0]
            if not len(bucket):
                continue
            rows = embed[bucket]
            vector = share @ rows
            logit = vector @ soft + bias
            p = np.exp(logit - logit.max())
            p /= p.sum()
            p[labels[d]] -= 1
            grad_vector = soft @ p
            grad_soft = np.outer(vector, p)
            grad_rows = share[:, None] * (grad_vector[None, :] + np.float32(DECAY) * rows)
            seen_e[bucket] += (grad_rows ** 2).mean(axis=1, keepdims=True)
            embed[bucket] = rows - step * grad_rows / np.sqrt(seen_e[bucket])
            seen_s += grad_soft ** 2
            soft -= step * grad_soft / np.sqrt(seen_s)
            seen_b += p ** 2
            bias -= step * p / np.sqrt(seen_b)
    return Model((embed @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for every whole text.

    NULL and empty texts have no subwords and get the bias's score.  Rows are
    independent: repeated rows and ids are scored each, an empty table gives
    an empty one, a column named ``out`` is replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BUCKET_BITS floats, whatever the corpus
    return add_columns(docs, [T.StructField(out, T.DoubleType())], lambda b: [
        pa.array(sent.value.scores(b.column(b.schema.get_field_index(text_col))).astype(np.float64))])
