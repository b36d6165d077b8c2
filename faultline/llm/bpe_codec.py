"""BPE encoding and decoding by speculation and verification (operator 9).

Encoding proposes, for every distinct pre-token, the greedy longest-match
tokens.  A sequence of tokens is what merging would give exactly when every
token encodes alone as itself and no merge crosses the boundary of an adjacent
pair before the pieces beside the boundary are taken by their own merges.  All
adjacent pairs are tested at once with array operations; only words with a
failing pair are merged exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrays import SpanHasher, doc_slices, remembered
from .frames import add_columns
from .vocabulary import NONE, TextEncoder, Vocabulary, pair_key, ragged_places, token_bytes, vocabulary

TOKENS_AT_ONCE = 1 << 20  # ids decoded together
LONGEST_GUESS = 256  # bytes; a longer word hardly ever passes, so it is merged at once


class Codec(TextEncoder):
    def __init__(self, vocab: Vocabulary):
        super().__init__(vocab)
        self.ordinary, self.by_bytes = vocab.whole_ids, vocab.whole_keys
        self.longest = max((len(vocab.token_bytes[i]) for i in self.ordinary.tolist()), default=1)
        self.bytes_len = np.array([len(b) for b in vocab.token_bytes], np.int64)
        self.merged_words = 0   # words that failed verification, for tests and tuning

    # -- speculate ----------------------------------------------------------

    def propose(self, hasher: SpanHasher, starts: np.ndarray, ends: np.ndarray):
        """Greedy longest-match tokens of every span: (token ids, word of each
        id), in word order.  Every byte is a token, so a match always exists."""
        word = np.flatnonzero(ends > starts)
        at = starts[word]
        words, tokens = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
        while len(word):
            room = np.minimum(ends[word] - at, self.longest)
            todo = np.arange(len(word))
            token = np.full(len(word), NONE, np.int32)
            for size in range(int(room.max()), 0, -1):
                try_now = todo[room[todo] >= size]
                if not len(try_now):
                    continue
                found = self.by_bytes.find(hasher.spans(at[try_now], at[try_now] + size))
                token[try_now] = found
                todo = todo[token[todo] == NONE]
                if not len(todo):
                    break
            ids = self.ordinary[token]
            words.append(word)
            tokens.append(ids)
            at = at + self.bytes_len[ids]
            more = at < ends[word]
            word, at = word[more], at[more]
        words, tokens = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(words, kind="stable")
        return tokens[order], words[order]

    # -- verify -------------------------------------------------------------

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether merging keeps each boundary between two adjacent tokens.

        Time runs backwards: the piece formed last is split again, and each
        pair of pieces that met at the boundary is tested: their merge would
        have crossed it if its rank comes before the left piece's own next
        merge, and not after the right piece's (equal ranks go left first).
        """
        v = self.vocab
        ok = np.ones(len(first), bool)
        todo = np.arange(len(first))
        a, b = first.astype(np.int32), second.astype(np.int32)
        until_a = np.full(len(a), NONE, np.int32)
        until_b = np.full(len(b), NONE, np.int32)
        while len(todo):
            crossing = v.pairs.find(pair_key(a, b))
            bad = (crossing < until_a) & (crossing <= until_b) & (crossing < NONE)
            ok[todo[bad]] = False
            made_a, made_b = v.rank_of[a], v.rank_of[b]
            go = ~bad & ((made_a >= 0) | (made_b >= 0))
            todo, a, b, made_a, made_b = todo[go], a[go], b[go], made_a[go], made_b[go]
            until_a, until_b = until_a[go], until_b[go]
            left = made_a > made_b
            until_a = np.where(left, made_a, until_a)
            until_b = np.where(left, until_b, made_b)
            a, b = np.where(left, v.right[made_a], a), np.where(left, b, v.left[made_b])
        return ok

    def encode_words(self, hasher: SpanHasher, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of the words of the hasher's buffer."""
        tokens, owner = self.propose(hasher, starts, np.where(ends - starts > LONGEST_GUESS, starts, ends))
        beside = np.flatnonzero(owner[1:] == owner[:-1])
        key = pair_key(tokens[beside], tokens[beside + 1])
        _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
        fine = self.compatible(tokens[beside[first]], tokens[beside[first] + 1])[inverse]
        counts = np.bincount(owner, minlength=len(starts))
        failing = np.union1d(owner[beside[~fine]], np.flatnonzero(ends - starts > LONGEST_GUESS))
        if not len(failing):
            return counts, tokens
        self.merged_words += len(failing)
        failed = np.zeros(len(starts), bool)
        failed[failing] = True
        kept = tokens[~failed[owner]]
        counts[failing], merged = self.vocab.merge(hasher.data, starts[failing], ends[failing])
        flat = np.zeros(int(counts.sum()), np.int32)
        begin = np.cumsum(counts) - counts
        flat[ragged_places(begin[~failed], counts[~failed])] = kept
        flat[ragged_places(begin[failing], counts[failing])] = merged
        return counts, flat


class Decoder:
    """Texts of id lists, from the tokens' bytes alone."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes_flat = np.frombuffer(b"".join(token_bytes), np.uint8)
        self.bytes_len = np.array([len(b) for b in token_bytes], np.int64)
        self.bytes_at = np.cumsum(self.bytes_len) - self.bytes_len

    def decode(self, column: pa.Array) -> pa.Array:
        """The text of every list of ids; bytes that are no UTF-8 become U+FFFD."""
        offsets = np.asarray(column.offsets).astype(np.int64)  # of a slice, places in the whole batch's values
        ids = np.asarray(column.values)
        out = []
        for i, j in doc_slices(offsets, TOKENS_AT_ONCE):
            mine = ids[offsets[i]:offsets[j]]
            sizes = self.bytes_len[mine]
            total = np.concatenate([[0], np.cumsum(sizes)])
            pick = np.arange(total[-1]) + np.repeat(self.bytes_at[mine] - total[:-1], sizes)
            raw = self.bytes_flat[pick].tobytes()
            bounds = total[offsets[i:j + 1] - offsets[i]].tolist()
            out += [raw[a:b].decode("utf-8", "replace") for a, b in zip(bounds[:-1], bounds[1:])]
        return pa.array(out, pa.string())


def codec(path: str) -> Codec:
    return remembered(("codec", path), lambda: Codec(vocabulary(path)))


def decoder(path: str) -> Decoder:
    return remembered(("decoder", path), lambda: Decoder(token_bytes(path)))


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the token ids of every whole text, as the tokenizer
    file's library gives them without special tokens of its own.

    NULL and empty texts have no ids (an empty list).  Rows are independent,
    so repeated rows and ids are encoded each; an empty table gives an empty
    one; a column named ``out`` is replaced.
    """
    return add_columns(docs, [T.StructField(out, T.ArrayType(T.IntegerType(), False))], lambda b: [
        codec(tokenizer).encode(b.column(b.schema.get_field_index(text_col)))])


def round_trip(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``: :func:`encode` and :func:`decode`
    in one pass, so one Python worker a task does both."""
    def both(batch):
        ids = codec(tokenizer).encode(batch.column(batch.schema.get_field_index(text_col)))
        return [ids, decoder(tokenizer).decode(ids)]
    return add_columns(docs, [T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
                              T.StructField("decoded", T.StringType())], both)


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of every id list, special tokens included.
    An empty list gives the empty text; a column named ``out`` is replaced."""
    return add_columns(encoded, [T.StructField(out, T.StringType())], lambda b: [
        decoder(tokenizer).decode(b.column(b.schema.get_field_index(ids_col)))])
