"""Byte-level BPE vocabulary of a tokenizer file as lookup arrays.

``Vocabulary`` holds what the encoders share: token bytes, the merge table as
an open-addressing hash table over numpy arrays, the split of text into
pre-tokens, and exact merging.  It is loaded once per Python worker.
"""

from __future__ import annotations

import json
import unicodedata
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa

from .arrays import SpanHasher, doc_slices, ragged, remembered, utf8_column

NONE = np.int32(np.iinfo(np.int32).max)
CACHED_WORDS = 500_000  # distinct pre-tokens whose ids a worker remembers, some 100 bytes each
LONG_WORD = 64   # bytes; longer words are merged one by one
ROWS_AT_ONCE = 20_000  # shorter words merged together
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values of the split pattern
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# The White_Space property, and the letters and numbers that Unicode 16 added.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
NEWER = {
    LETTER: [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
             (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
             (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
             (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
             (0x1E5F0, 0x1E5F0)],
    NUMBER: [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
             (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)],
}


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    return remembered("char classes", _char_classes)


def _char_classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    major = np.array([unicodedata.category(chr(c))[0] for c in range(0x110000)])
    out[major == "L"], out[major == "N"] = LETTER, NUMBER
    for kind, ranges in NEWER.items():
        for first, last in ranges:
            out[first:last + 1] = kind
    out[WHITE_SPACE] = SPACE
    return out


class HashTable:
    """Position of distinct 64-bit keys in the order they were added, for
    arrays of keys at once, by open addressing at a load of a half at most."""

    def __init__(self, keys: np.ndarray):
        self.size = 0
        self._resize(len(keys))
        self.add(keys)

    def _resize(self, size: int) -> None:
        self.bits = max(4, int(size * 4).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.at = np.full(1 << self.bits, NONE, np.int32)

    def add(self, keys: np.ndarray) -> None:
        """``keys``, none of them in the table, take the next positions."""
        if 2 * (self.size + len(keys)) > len(self.at):
            old, at = self.keys[self.at != NONE], self.at[self.at != NONE]
            self._resize(self.size + len(keys))
            self._place(old, at)
        self._place(keys, np.arange(self.size, self.size + len(keys), dtype=np.int32))
        self.size += len(keys)

    def _place(self, keys: np.ndarray, at: np.ndarray) -> None:
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.at[slot[todo]] == NONE]
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]] = keys[placed]
            self.at[slot[placed]] = at[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys):
        return ((keys * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, ``NONE`` where it is absent."""
        slot = self._slot(keys)
        at = self.at[slot]
        out = np.where(self.keys[slot] == keys, at, NONE)
        todo = np.flatnonzero((out == NONE) & (at != NONE))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            at = self.at[slot[todo]]
            hit = (self.keys[slot[todo]] == keys[todo]) & (at != NONE)
            out[todo[hit]] = at[hit]
            todo = todo[~hit & (at != NONE)]
        return out


def spans_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``words`` as one buffer with starts and ends."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return np.frombuffer(b"".join(words), np.uint8), ends - [len(w) for w in words], ends


def ragged_places(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begin, begin + 1 .. begin + count - 1 of every run, in one row."""
    total = np.cumsum(counts)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(begin - (total - counts), counts)


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


def _spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = spec.get("added_tokens") or []
    if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" \
            or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path}: not a plain byte-level BPE file")
    if any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added):
        raise ValueError(f"{path}: added tokens that match by more than their text")
    return spec


def _token_bytes(spec: dict) -> list[bytes]:
    ids, added = spec["model"]["vocab"], spec.get("added_tokens") or []
    of_char = byte_alphabet()
    out = [b""] * (1 + max([*ids.values(), *(a["id"] for a in added)]))
    for token, i in ids.items():
        out[i] = bytes(of_char[c] for c in token)
    for a in added:
        out[a["id"]] = a["content"].encode()
    return out


def token_bytes(path: str) -> list[bytes]:
    """The bytes of every token id of a tokenizer file."""
    return _token_bytes(_spec(path))


class Vocabulary:
    def __init__(self, path: str):
        spec = _spec(path)
        model, ids = spec["model"], spec["model"]["vocab"]
        of_char = byte_alphabet()
        self.token_bytes = _token_bytes(spec)
        self.added = {a["content"].encode(): a["id"] for a in spec.get("added_tokens") or []}
        size = len(self.token_bytes)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int32)
        self.right = np.array([ids[b] for _, b in pairs], np.int32)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        self.byte_id = np.zeros(256, np.int32)
        for c, b in of_char.items():
            self.byte_id[b] = ids[c]
        self.pairs = HashTable(pair_key(self.left, self.right))
        self._plain = None
        self.rank_of = np.full(size, -1, np.int32)  # rank of the merge that makes a token, -1 for bytes
        self.rank_of[self.merged[::-1]] = np.arange(len(pairs), dtype=np.int32)[::-1]
        ordinary = sorted(set(ids.values()))
        counts, flat = self.merge(*spans_of([self.token_bytes[i] for i in ordinary]))
        alone = np.zeros(size, bool)  # the token's own bytes merge to it and nothing else
        first = np.r_[0, np.cumsum(counts)[:-1]]
        single = counts == 1
        alone[np.array(ordinary)[single]] = flat[first[single]] == np.array(ordinary)[single]
        self.alone = alone
        self.whole_ids = np.array(ordinary, np.int32)[alone[ordinary]]
        data, starts, ends = spans_of([self.token_bytes[i] for i in self.whole_ids.tolist()])
        self.whole_keys = HashTable(SpanHasher(data).spans(starts, ends))

    # -- pre-tokens ---------------------------------------------------------

    def pretokens(self, data: np.ndarray, offsets: np.ndarray):
        """Split documents of one UTF-8 buffer as the vocabulary's pattern does:
        (byte starts, byte ends, counts per document, added-token id or -1).

        A pre-token is a run of letters, numbers or other symbols with one
        space before it, a run of white space, or a contraction's ending.
        """
        edges = np.asarray(offsets, np.int64)
        special_at = {}
        if self.added:
            raw = data.tobytes()
            for content, i in self.added.items():
                at = raw.find(content)
                while at >= 0:
                    doc = int(np.searchsorted(offsets, at, side="right")) - 1
                    if at + len(content) <= offsets[doc + 1]:
                        special_at[at] = (at + len(content), i)
                    at = raw.find(content, at + len(content))
            if special_at:
                marks = [x for at, (end, _) in special_at.items() for x in (at, end)]
                edges = np.unique(np.concatenate([edges, np.array(marks, np.int64)]))
        first_bytes = np.flatnonzero((data & 0xC0) != 0x80)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        n = len(points)
        if n == 0:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(len(offsets) - 1, np.int64), np.zeros(0, np.int32))
        kind = char_classes()[points]
        fresh = np.zeros(n + 1, bool)  # a text starts (or ends) here
        fresh[np.searchsorted(first_bytes, edges)] = True
        start = fresh[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # the last white space before a run leaves its own run; a plain space joins the next
        after = np.flatnonzero(start[1:] & ~fresh[1:n] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
        start[after - 1] = True
        start[after[points[after - 1] == 32]] = False
        # contractions: an apostrophe that starts a pre-token, and the ending after it
        quotes = np.flatnonzero(start & (points == 39))
        for ending in CONTRACTIONS:
            m = len(ending)
            q = quotes[quotes + m < n]
            ok = np.ones(len(q), bool)
            for k, c in enumerate(ending, 1):
                ok &= (points[q + k] == ord(c)) & ~fresh[q + k]
            q = q[ok]
            start[q + 1] = False
            beyond = q[q + m + 1 < n] + m + 1
            start[beyond] = True
        at = np.flatnonzero(start)
        starts = first_bytes[at].astype(np.int64)
        ends = np.append(starts[1:], len(data))
        special = np.full(len(starts), -1, np.int32)
        if special_at:
            # an added token is one piece, whatever the pattern makes of its text
            opening = np.array(sorted(special_at), np.int64)
            closing = np.array([special_at[a][0] for a in opening], np.int64)
            owner = np.searchsorted(opening, starts, side="right") - 1
            inside = (owner >= 0) & (starts < closing[np.maximum(owner, 0)])
            head = inside & (starts == opening[np.maximum(owner, 0)])
            special[head] = [special_at[int(a)][1] for a in starts[head]]
            ends[head] = closing[owner[head]]
            keep = ~inside | head
            starts, ends, special = starts[keep], ends[keep], special[keep]
        counts = np.diff(np.searchsorted(starts, offsets))
        return starts, ends, counts, special

    # -- exact merging ------------------------------------------------------

    def merge(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact BPE of every word data[start:end]: (tokens per word, token ids
        in one row).

        Words of similar length are merged together: each round finds every
        word's lowest-ranked adjacent pair (leftmost on ties) and joins it.
        """
        lengths = ends - starts
        counts = np.zeros(len(starts), np.int64)
        order = np.argsort(lengths, kind="stable")
        order = order[lengths[order] > 0]
        short = order[lengths[order] <= LONG_WORD]
        parts = []
        for lo in range(0, len(short), ROWS_AT_ONCE):
            group = short[lo:lo + ROWS_AT_ONCE]
            ids, counts[group] = self._merge_rows(data, starts[group], lengths[group])
            parts.append((group, ids))
        for i in order[lengths[order] > LONG_WORD].tolist():
            ids = self._merge_long(data[starts[i]:ends[i]])
            counts[i] = len(ids)
            parts.append((np.array([i]), ids))
        flat = np.zeros(int(counts.sum()), np.int32)
        begin = np.cumsum(counts) - counts
        for group, ids in parts:
            flat[ragged_places(begin[group], counts[group])] = ids
        return counts, flat

    def _merge_rows(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """(ids of all words in one row, ids per word) of words of similar length."""
        width = int(lengths.max())
        ids = np.full((len(starts), width + 1), -1, np.int32)
        inside = np.arange(width + 1) < lengths[:, None]
        ids[inside] = self.byte_id[data[ragged_places(starts, lengths)]]
        left = lengths.copy()
        ranks = np.full((len(starts), width), NONE, np.int32)  # of each pair of neighbours
        real = inside[:, 1:]
        ranks[real] = self.pairs.find(pair_key(ids[:, :-1][real], ids[:, 1:][real]))
        active, a, r = np.arange(len(starts)), ids, ranks
        while len(active):
            at = r.argmin(axis=1)
            best = r[np.arange(len(active)), at]
            some = best < NONE
            if not some.all():
                ids[active[~some], :a.shape[1]] = a[~some]
                active, a, r, at, best = active[some], a[some], r[some], at[some], best[some]
                if not len(active):
                    break
            row = np.arange(len(active))
            column = np.arange(a.shape[1])
            joined = np.empty((len(active), a.shape[1]), np.int32)
            joined[:, :-1] = np.where(column[:-1] > at[:, None], a[:, 1:], a[:, :-1])
            joined[:, -1] = -1
            joined[row, at] = self.merged[best]
            shifted = np.empty((len(active), r.shape[1]), np.int32)
            shifted[:, :-1] = np.where(column[:-2] > at[:, None], r[:, 1:], r[:, :-1])
            shifted[:, -1] = NONE
            left[active] -= 1
            a, r = joined, shifted
            for first, there in ((at - 1, at > 0), (at, at + 1 < left[active])):  # the pairs beside the new token
                i, j = row[there], first[there]
                r[i, j] = self.pairs.find(pair_key(a[i, j], a[i, j + 1]))
            last = at + 1 >= left[active]
            r[row[last], at[last]] = NONE
        return ids[np.arange(width + 1) < left[:, None]], left

    def _merge_long(self, word: np.ndarray) -> np.ndarray:
        """One long word: a heap of its pairs by rank and place, and each token's neighbours."""
        ids = self.byte_id[word]
        n = len(ids)
        ranks = self.pairs.find(pair_key(ids[:-1], ids[1:])).astype(np.int64)
        heap = np.sort(ranks[ranks < NONE] * n + np.flatnonzero(ranks < NONE)).tolist()
        if not heap:
            return ids
        rank_of_pair, (left, right, merged) = self._merges()
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, at = divmod(heappop(heap), n)
            other = after[at]
            if ids[at] != left[rank] or other == n or ids[other] != right[rank]:
                continue  # one of the two was joined since
            ids[at], ids[other] = merged[rank], -1
            beyond = after[at] = after[other]
            if beyond < n:
                before[beyond] = at
            for i, j in ((before[at], at), (at, beyond)):
                if i >= 0 and j < n and (new := rank_of_pair.get(ids[i] << 32 | ids[j])) is not None:
                    heappush(heap, new * n + i)
        return np.array([i for i in ids if i >= 0], np.int32)

    def _merges(self):
        """Ranks by pair, and (left, right, merged) of each rank, as plain Python; for long words only."""
        if self._plain is None:
            keys = pair_key(self.left, self.right).tolist()
            self._plain = dict(zip(keys, range(len(keys)))), (self.left.tolist(), self.right.tolist(), self.merged.tolist())
        return self._plain


def vocabulary(path: str) -> Vocabulary:
    return remembered(("vocabulary", path), lambda: Vocabulary(path))


class WordCache:
    """Per-worker memory of the values (int32) of every distinct pre-token,
    filled by ``encode`` (span hasher, starts, ends -> values per word, all
    values).  Beyond ``limit`` words it forgets the older half, so its memory
    stays bounded however many words a corpus has."""

    def __init__(self, encode, limit: int = CACHED_WORDS):
        self.encode, self.limit = encode, limit
        self._set(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))

    def _set(self, keys: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        self.table = HashTable(keys)
        self.keys, self.counts, self.flat = Growing(keys), Growing(counts), Growing(flat)
        self.begin = Growing(np.cumsum(counts) - counts)

    def _forget(self) -> None:
        half = self.table.size // 2
        first = int(self.begin.values()[half])
        self._set(self.keys.values()[half:].copy(), self.counts.values()[half:].copy(), self.flat.values()[first:].copy())

    def lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of every word; its values are flat[begin:begin + count]."""
        if self.table.size > self.limit:
            self._forget()
        hasher = SpanHasher(data)
        keys = hasher.spans(starts, ends)
        at = self.table.find(keys)
        missing = np.flatnonzero(at == NONE)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            words = missing[first]
            counts, flat = self.encode(hasher, starts[words], ends[words])
            self.begin.append(len(self.flat) + np.cumsum(counts) - counts)
            for column, values in ((self.keys, new), (self.counts, counts), (self.flat, flat)):
                column.append(values)
            self.table.add(new)
            at[missing] = self.table.find(keys[missing])
        return at


class Growing:
    """An array that values are appended to."""

    def __init__(self, values: np.ndarray):
        self.buffer, self.size = values, len(values)

    def __len__(self) -> int:
        return self.size

    def values(self) -> np.ndarray:
        return self.buffer[:self.size]

    def append(self, values: np.ndarray) -> None:
        size = self.size + len(values)
        if size > len(self.buffer):
            self.buffer = np.concatenate([self.values(), np.empty(max(len(values), self.size // 2), self.buffer.dtype)])
        self.buffer[self.size:size] = values
        self.size = size


class TextEncoder:
    """Token ids of whole texts, each distinct pre-token encoded once while it
    is remembered: here by the vocabulary itself or by exact merging."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.cache = WordCache(self.encode_words)

    def encode_words(self, hasher: SpanHasher, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids per word, all ids) of the words of the hasher's buffer."""
        return encode_whole(self.vocab, hasher, starts, ends)

    def encode(self, column: pa.Array) -> pa.Array:
        """Id list of every text of a string column; NULL has none."""
        data, offsets = utf8_column(column)
        flats, sizes = [], np.zeros(len(offsets) - 1, np.int64)
        for i, j in doc_slices(offsets):
            part = data[offsets[i]:offsets[j]]
            starts, ends, words, special = self.vocab.pretokens(part, offsets[i:j + 1] - offsets[i])
            if not len(starts):
                continue
            at = self.cache.lookup(part, starts, ends)
            each, begin, flat = self.cache.counts.values()[at], self.cache.begin.values()[at], self.cache.flat.values()
            marked = np.flatnonzero(special >= 0)
            if len(marked):  # added tokens: one id, whatever the word cache says of their text
                begin[marked] = np.arange(len(marked)) + len(flat)
                flat = np.append(flat, special[marked])
                each[marked] = 1
            total = np.concatenate([[0], np.cumsum(each)])
            flats.append(flat[ragged_places(begin, each)])
            upto = np.concatenate([[0], np.cumsum(words)])
            sizes[i:j] = total[upto[1:]] - total[upto[:-1]]
        return ragged(np.concatenate(flats) if flats else np.zeros(0, np.int32), sizes, pa.int32())


def encode_whole(vocab: Vocabulary, hasher: SpanHasher, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids per word, all ids): words that are tokens alone by lookup, the rest by exact merging."""
    found = vocab.whole_keys.find(hasher.spans(starts, ends))
    known = found != NONE
    counts = np.ones(len(starts), np.int64)
    counts[~known], merged = vocab.merge(hasher.data, starts[~known], ends[~known])
    flat = np.zeros(int(counts.sum()), np.int32)
    begin = np.cumsum(counts) - counts
    flat[begin[known]] = vocab.whole_ids[found[known]]
    flat[ragged_places(begin[~known], counts[~known])] = merged
    return counts, flat


def text_encoder(path: str) -> TextEncoder:
    return remembered(("text encoder", path), lambda: TextEncoder(vocabulary(path)))
