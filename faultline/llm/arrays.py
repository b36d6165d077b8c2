"""Text columns as numpy arrays: the per-batch helpers of the operators.

A batch of documents arrives as one Arrow string column, that is one byte
buffer and the documents' offsets.  Hashing, word splitting and window
arithmetic run on that buffer with array operations; nothing here loops over
characters or words in Python.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19  # documents handled together, so temporaries stay small; a longer text goes alone
LONG_SPAN = 128  # bytes; modulo 2**64 the polynomial hash is the same for some pairs of regular texts from 1,024 bytes on

_MULTIPLIER = 0xD1342543DE82EF95  # odd, so powers have inverses modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_BYTE_CODE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def remembered(key, make: Callable):
    """``make()`` once per process and key.

    Functions reach the workers by value, so their own globals live for one
    task; tables that are costly to build are kept in a module of the worker's
    interpreter instead, and serve all its tasks.
    """
    store = sys.modules.setdefault("_faultline_llm_memory", ModuleType("_faultline_llm_memory")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0]:ends[-1]], ends - ends[0]


def doc_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of consecutive documents holding at most ``limit`` bytes
    together, or one longer document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xE9846AF9B1A615D)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xE9846AF9B1A615D)
    return x ^ (x >> np.uint64(28))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
    filled = 1
    while filled < n:
        step = min(filled, n - filled)
        out[filled:filled + step] = out[:step] * np.uint64(pow(base, filled, 1 << 64))
        filled += step
    return out


class SpanHasher:
    """64-bit hashes of byte spans of one buffer, each in constant time.

    The buffer's bytes become random odd codes; a prefix sum of code times
    power gives every span's polynomial hash as one difference.  Spans of more
    than LONG_SPAN bytes have a cryptographic digest instead.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.data = data
        size = 1 << max(20, int(n).bit_length())
        def make():
            return _powers(_MULTIPLIER, size), _powers(_INVERSE, size)
        # the powers for one very long text are not kept
        up, self.down = remembered(("powers", size), make) if size <= 4 * SLICE_BYTES else make()
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODE[data] * up[:n], out=self.prefix[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = mix((self.prefix[ends] - self.prefix[starts]) * self.down[starts])
        for i in np.flatnonzero(ends - starts > LONG_SPAN).tolist():
            digest = hashlib.blake2b(self.data[starts[i]:ends[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
        return out

    def windows(self, length: int) -> np.ndarray:
        """Hash of the ``length`` bytes from every position that has as many."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[length:] - self.prefix[:n]) * self.down[:n])


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, other bytes untouched."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def ascii_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per document) of the maximal runs of bytes other
    than space and 0x09-0x0D; a word never crosses documents."""
    n = len(data)
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a document starts or the buffer ends here
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
