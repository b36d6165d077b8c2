"""Token counts by the whole-token shortcut (operator 6).

Exact merging of every vocabulary string proves which of them encode alone as
one token (``Vocabulary.whole``).  A pre-token among those counts one without
any merging; only the rest is merged, and each distinct word once per worker.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import SpanHasher, doc_slices, remembered, utf8_column
from .frames import add_columns
from .vocabulary import NONE, Vocabulary, WordCache, vocabulary


def _count_words(vocab: Vocabulary, hasher: SpanHasher, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One value per word, its tokens: one for a whole token, counted merging for the rest."""
    out = np.ones(len(starts), np.int32)
    rest = vocab.whole_keys.find(hasher.spans(starts, ends)) == NONE
    out[rest], _ = vocab.merge(hasher.data, starts[rest], ends[rest])
    return np.ones(len(starts), np.int64), out


def _counts(path: str, column: pa.Array) -> np.ndarray:
    vocab = vocabulary(path)
    cache = remembered(("token counts", path), lambda: WordCache(partial(_count_words, vocab)))
    data, offsets = utf8_column(column)
    out = np.zeros(len(offsets) - 1, np.int64)
    for i, j in doc_slices(offsets):
        part = data[offsets[i]:offsets[j]]
        starts, ends, words, special = vocab.pretokens(part, offsets[i:j + 1] - offsets[i])
        if not len(starts):
            continue
        at = cache.lookup(part, starts, ends)
        tokens = cache.flat.values()[at].astype(np.int64)  # one value an entry
        tokens[special >= 0] = 1
        total = np.concatenate([[0], np.cumsum(tokens)])
        upto = np.concatenate([[0], np.cumsum(words)])
        out[i:j] = total[upto[1:]] - total[upto[:-1]]
    return out


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 1024, text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than
    ``limit`` tokens).

    Every whole text is counted as the tokenizer file's library does without
    special tokens of its own; special strings inside a text count one.  NULL
    and empty texts have 0 bytes and 0 tokens.  Repeated rows and ids are
    counted each; an empty table gives an empty one; columns named like the
    three new ones are replaced.
    """
    fields = [T.StructField("n_tokens", T.LongType())]
    counted = add_columns(docs, fields, lambda b: [pa.array(_counts(
        tokenizer, b.column(b.schema.get_field_index(text_col))))])
    return (counted.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
