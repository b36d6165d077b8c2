"""Repeated byte strings by a partitioned enhanced suffix array (operator 5).

Every string of ``min_bytes`` bytes contains one *anchor*: the leftmost
occurrence of its smallest-hashed 24-byte gram.  Equal strings have equal
anchors at equal places, so the strings of an anchor can be compared apart
from all others:

1.  Anchors of all documents are dealt by hash; those in one document only
    cannot be part of a repeat and are dropped.
2.  The bytes around the remaining anchors (*segments*, at most
    2 * min_bytes - 24 bytes) are dealt by anchor.  Each partition builds the
    suffix array of its segments with the common-prefix lengths, scans it with
    a stack for the intervals of the common-prefix tree, and reports each
    interval whose left neighbours differ: the maximal repeats with all their
    occurrences.
3.  Occurrences in any but the smallest document of a group become spans;
    spans of a document are merged and cut out.

Equal documents are one text from step 2 on.  Within a task, equal segments
are sent once, so a passage that very many documents share costs one row a
task; the segments of a very frequent anchor are dealt by longer content.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import SpanHasher, doc_slices, utf8_column
from .frames import add_columns, written_step

GRAM = 24               # bytes of an anchor
ANCHORS_A_PART = 1 << 20  # anchors that one partition compares at once, on average
FLUSH = 1 << 20         # anchors a task gathers before it sends them
HOT_LEAST = 2000        # an anchor of more occurrences may be dealt by longer content;
HOT_SHARE = 1_000_000   # at most so many anchors are: those above total / HOT_SHARE
HOT_STEP = 4            # windows of a hot anchor that are dealt together
CHUNK = 1 << 13         # segments of one suffix array
NO_ID = np.iinfo(np.int64).max


def anchors(data: np.ndarray, offsets: np.ndarray, length: int):
    """Anchors of all ``length``-byte windows inside documents: (place,
    first window, last window, gram hash), ascending; windows first..last are
    those whose anchor it is."""
    empty = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    n = len(data) - length + 1
    if n <= 0:
        return empty
    value = SpanHasher(data).windows(GRAM)
    grams = value
    place = np.arange(len(value), dtype=np.int32)
    width, have = length - GRAM + 1, 1

    def join(v, p, shift):
        lower = v[shift:] < v[:-shift]  # the left one stays on ties
        return np.where(lower, v[shift:], v[:-shift]), np.where(lower, p[shift:], p[:-shift])
    while have * 2 <= width:
        value, place = join(value, place, have)
        have *= 2
    if have < width:
        value, place = join(value, place, width - have)
    outside = np.zeros(len(data) + 1, np.int32)
    np.add.at(outside, np.maximum(offsets[:-1], offsets[1:] - length + 1), 1)
    np.add.at(outside, offsets[1:], -1)
    start = np.flatnonzero(np.cumsum(outside[:n]) == 0)
    if not len(start):
        return empty
    place = place[start].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.append(first[1:], len(place)) - 1
    return place[first], start[first], start[last], grams[place[first]]


# -- packed columns -------------------------------------------------------------

def _pack(values: np.ndarray) -> bytes:
    """An array as compressed byte planes."""
    raw = np.ascontiguousarray(values)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpack(blob: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).reshape(-1)


def _gathered(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([_unpack(b, kind) for b in table.column(name).to_pylist()])


def _by_part(part: np.ndarray, parts: int):
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


# -- step 1: anchors of more than one document ------------------------------------

_ANCHORS = {"doc": np.int64, "pos": np.uint32, "gram": np.uint32,  # in one document of the task so far
            "many": np.uint32, "count": np.uint32,                 # in several, with their number
            "sure_doc": np.int64, "sure_pos": np.uint32}           # occurrences of those
_ANCHOR_ROWS = T.StructType([T.StructField("part", T.IntegerType())] +
                            [T.StructField(n, T.BinaryType()) for n in _ANCHORS])
_CANDIDATES = T.StructType([T.StructField("doc", T.LongType()), T.StructField("pos", T.IntegerType()),
                            T.StructField("hot", T.LongType())])


def _find_anchors(length: int, parts: int):
    def flush(held):
        doc, pos, gram = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((doc, gram))
        doc, pos, gram = doc[order], pos[order], gram[order]
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        size = np.diff(np.append(first, len(gram)))
        several = doc[first] != doc[first + size - 1]
        each = np.repeat(several, size)
        part = ((gram >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
        order, bounds = _by_part(part, parts)
        head = np.zeros(len(gram), bool)
        head[first[several]] = True
        count = np.zeros(len(gram), np.uint32)
        count[first] = size
        for p in range(parts):
            at = np.sort(order[bounds[p]:bounds[p + 1]])
            if not len(at):
                continue
            one, sure, heads = at[~each[at]], at[each[at]], at[head[at]]
            one = one[np.lexsort((pos[one], doc[one]))]
            yield {"part": p, "doc": _pack(doc[one]), "pos": _pack(pos[one]), "gram": _pack(gram[one].astype(np.uint32)),
                   "many": _pack(gram[heads].astype(np.uint32)), "count": _pack(count[heads]),
                   "sure_doc": _pack(doc[sure]), "sure_pos": _pack(pos[sure])}

    def run(batches):
        held, total = [], 0

        def out():
            rows = list(flush(held))
            return pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in _ANCHOR_ROWS.names},
                                              schema=pa.schema([("part", pa.int32())] + [(n, pa.binary()) for n in _ANCHORS]))
        for batch in batches:
            data, offsets = utf8_column(batch.column(batch.schema.get_field_index("text")))
            ids = np.asarray(batch.column(batch.schema.get_field_index("doc")))
            for i, j in doc_slices(offsets):
                bounds = offsets[i:j + 1] - offsets[i]
                place, _, _, gram = anchors(data[offsets[i]:offsets[j]], bounds, length)
                if not len(place):
                    continue
                owner = np.searchsorted(bounds, place, side="right") - 1
                held.append((ids[i:j][owner], (place - bounds[owner]).astype(np.uint32), gram))
                total += len(place)
                if total >= FLUSH:
                    yield out()
                    held, total = [], 0
        if held:
            yield out()
    return run


def _shared_anchors(hot_from: int):
    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        got = {n: _gathered(table, n, k) for n, k in _ANCHORS.items()}
        order = np.lexsort((got["doc"], got["gram"]))
        gram, doc, pos = got["gram"][order], got["doc"][order], got["pos"][order]
        many, back = np.unique(got["many"], return_inverse=True)
        total = np.bincount(back, got["count"], minlength=len(many)) if len(many) else np.zeros(0)
        if len(gram):
            first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            size = np.diff(np.append(first, len(gram)))
            at = np.searchsorted(many, gram[first])
            known = np.zeros(len(first), bool)
            if len(many):
                known = many[np.minimum(at, len(many) - 1)] == gram[first]
                np.add.at(total, at[known], size[known])
            several = known | (doc[first] != doc[first + size - 1])
            each = np.repeat(several, size)
            alone = several & ~known
            hot = np.concatenate([many[total >= hot_from], gram[first][alone & (size >= hot_from)]])
            doc, pos = doc[each], pos[each]
        else:
            hot = many[total >= hot_from]
        doc, pos = np.concatenate([doc, got["sure_doc"]]), np.concatenate([pos, got["sure_pos"]])
        hot = (np.int64(part) << np.int64(32)) | hot.astype(np.int64)
        n = len(doc)
        return pa.table({
            "doc": pa.array(np.concatenate([doc, np.zeros(len(hot), np.int64)])),
            "pos": pa.array(np.concatenate([pos, np.zeros(len(hot))]).astype(np.int32)),
            "hot": pa.array(np.concatenate([np.full(n, -1), hot]).astype(np.int64))})
    return run


# -- step 2: segments and their suffix arrays -------------------------------------

_SEGMENTS = {"bytes": np.uint8, "size": np.uint8, "key": np.uint32, "doc": np.int64, "mark": np.uint32,
             "start": np.uint32, "span_doc": np.int64, "span_mark": np.uint32, "span_start": np.uint32,
             "span_size": np.uint8}
_SEGMENT_ROWS = T.StructType([T.StructField("part", T.IntegerType())] +
                             [T.StructField(n, T.BinaryType()) for n in _SEGMENTS])
_SPANS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("mark", T.LongType()),
                       T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])


def _cut(hasher: SpanHasher, place, first, last, gram, hot_grams, parts: int, length: int):
    """Segments of the chosen anchors: (key, first window, last window).  A hot
    anchor's windows go in steps, each keyed by the bytes that all of the
    step's windows share, so its segments spread over the partitions."""
    ident = ((((gram >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32)) | (gram & np.uint64(0xFFFFFFFF))).astype(np.int64)
    hot = np.isin(ident, hot_grams)
    keys, firsts, lasts = [gram[~hot]], [first[~hot]], [last[~hot]]
    for step in range(0, length - GRAM + 1, HOT_STEP):
        lo = np.maximum(first[hot], place[hot] - step - HOT_STEP + 1)
        hi = np.minimum(last[hot], place[hot] - step)
        some = lo <= hi
        core_at = place[hot][some] - step
        keys.append(hasher.spans(core_at, core_at - HOT_STEP + 1 + length))
        firsts.append(lo[some])
        lasts.append(hi[some])
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(lasts)


def _send_segments(length: int, parts: int, hot_grams: np.ndarray):
    def flush(held):
        key, doc, mark, start, size, same = (np.concatenate(x) for x in list(zip(*held))[:6])
        data = np.concatenate([h[6] for h in held])
        at = np.cumsum(size.astype(np.int64)) - size
        # equal segments of the task: the smallest document speaks for all, the others are spans already
        order = np.lexsort((doc, same))
        fresh = np.concatenate([[True], same[order][1:] != same[order][:-1]])
        lowest = doc[order][fresh][np.cumsum(fresh) - 1]
        later = np.zeros(len(doc), bool)
        later[order] = doc[order] > lowest
        order, bounds = _by_part(((key >> np.uint64(32)) % np.uint64(parts)).astype(np.int32), parts)
        for p in range(parts):
            mine = order[bounds[p]:bounds[p + 1]]
            if not len(mine):
                continue
            span, mine = mine[later[mine]], mine[~later[mine]]
            sizes = size[mine].astype(np.int64)
            ends = np.cumsum(sizes)
            pick = np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[mine] - (ends - sizes), sizes)
            yield {"part": p, "bytes": _pack(data[pick]), "size": _pack(size[mine]),
                   "key": _pack(key[mine].astype(np.uint32)), "doc": _pack(doc[mine]), "mark": _pack(mark[mine]),
                   "start": _pack(start[mine]), "span_doc": _pack(doc[span]), "span_mark": _pack(mark[span]),
                   "span_start": _pack(start[span]), "span_size": _pack(size[span])}

    def run(batches):
        held, total = [], 0

        def out():
            rows = list(flush(held))
            return pa.RecordBatch.from_pydict({n: [r[n] for r in rows] for n in _SEGMENT_ROWS.names},
                                              schema=pa.schema([("part", pa.int32())] + [(n, pa.binary()) for n in _SEGMENTS]))
        for batch in batches:
            column = {n: batch.column(batch.schema.get_field_index(n)) for n in ("text", "doc", "mark", "places")}
            data, offsets = utf8_column(column["text"])
            ids, marks = np.asarray(column["doc"]), np.asarray(column["mark"]).astype(np.uint32)
            listed = np.asarray(column["places"].offsets).astype(np.int64)
            places = np.asarray(column["places"].values).astype(np.int64)
            for i, j in doc_slices(offsets):
                part, bounds = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                place, first, last, gram = anchors(part, bounds, length)
                wanted = np.zeros(len(part) + 1, bool)
                mine = places[listed[i]:listed[j]] + np.repeat(bounds[:-1], np.diff(listed[i:j + 1]))
                wanted[np.minimum(mine, len(part))] = True
                keep = wanted[place]
                if not keep.any():
                    continue
                hasher = SpanHasher(part)
                key, first, last = _cut(hasher, place[keep], first[keep], last[keep], gram[keep], hot_grams, parts, length)
                stop = last + length
                size = (stop - first).astype(np.uint8)
                ends = np.cumsum(size.astype(np.int64))
                pick = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
                owner = np.searchsorted(bounds, first, side="right") - 1
                held.append((key, ids[i:j][owner], marks[i:j][owner], (first - bounds[owner]).astype(np.uint32), size,
                             hasher.spans(first, stop) ^ key, part[pick]))
                total += len(key)
                if total >= FLUSH // 4:
                    yield out()
                    held, total = [], 0
        if held:
            yield out()
    return run


def suffix_array(rows: np.ndarray, sizes: np.ndarray, length: int):
    """Sorted suffixes of at least ``length`` bytes of all segments (rows of a
    zero-padded matrix): (segment, start, common prefix with the suffix before)."""
    count = np.maximum(0, sizes - length + 1)
    segment = np.repeat(np.arange(len(rows)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    width = rows.shape[1]
    padded = np.concatenate([rows, np.zeros((len(rows), width), np.uint8)], axis=1)
    suffix = np.lib.stride_tricks.sliding_window_view(padded, width, axis=1)[segment, start]
    order = np.argsort(np.ascontiguousarray(suffix).view(f"V{width}").reshape(-1), kind="stable")
    segment, start, suffix = segment[order], start[order], suffix[order]
    room = sizes[segment] - start
    differs = suffix[1:] != suffix[:-1]
    common = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    common = np.minimum(common, np.minimum(room[1:], room[:-1]))
    return segment, start, np.concatenate([[0], common])


def maximal_repeats(common: np.ndarray, before: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """Intervals of the common-prefix tree of ``length`` and more that cannot be
    extended to the left: (first suffix, last suffix, common length).

    One scan with a stack of open intervals, each with the byte that precedes
    all its suffixes so far: -1 once two differ or one is unknown.
    """
    out = []
    inside = np.flatnonzero(common >= length)
    if not len(inside):
        return out
    cuts = np.flatnonzero(np.diff(inside) > 1)
    for run in np.split(inside, cuts + 1):
        lo = int(run[0]) - 1
        left = before[lo:int(run[-1]) + 1].tolist()
        stack: list[list[int]] = []  # [common length, first suffix, preceding byte]
        for k, depth in enumerate(common[run].tolist(), 1):
            first, byte = lo + k - 1, left[k - 1]
            while stack and stack[-1][0] > depth:
                done, at, seen = stack.pop()
                seen = seen if seen == byte else -1
                if seen < 0:
                    out.append((at, lo + k - 1, done))
                first, byte = at, seen
            if stack and stack[-1][0] == depth:
                if stack[-1][2] != byte:
                    stack[-1][2] = -1
            else:
                stack.append([depth, first, byte])
        last, byte = lo + len(run), left[-1]
        while stack:
            done, at, seen = stack.pop()
            seen = seen if seen == byte else -1
            if seen < 0:
                out.append((at, last, done))
            byte = seen
    return out


def _covered(rows: np.ndarray, sizes: np.ndarray, doc: np.ndarray, length: int):
    """For distinct segments with their smallest documents: the bytes [start,
    stop) of each that a smaller document of its repeat groups holds (start =
    stop: none).  Windows of one segment overlap, so these bytes are one run."""
    segment, at, common = suffix_array(rows, sizes, length)
    before = np.where(at > 0, rows[segment, np.maximum(at - 1, 0)].astype(np.int64), -1)
    owner = doc[segment]
    start = np.full(len(rows), 1 << 30)
    stop = np.full(len(rows), -1)
    for lo, hi, size in maximal_repeats(common, before, length):
        docs = owner[lo:hi + 1]
        later = np.flatnonzero(docs > docs.min()) + lo
        if len(later):
            np.minimum.at(start, segment[later], at[later])
            np.maximum.at(stop, segment[later], at[later] + size)
    return start, stop


def _repeat_spans(length: int):
    def run(table: pa.Table) -> pa.Table:
        got = {n: _gathered(table, n, k) for n, k in _SEGMENTS.items()}
        sizes = got["size"].astype(np.int64)
        ends = np.cumsum(sizes)
        width = 2 * length - GRAM
        spans = [(got["span_doc"], got["span_mark"], got["span_start"].astype(np.int64),
                  got["span_start"].astype(np.int64) + got["span_size"])]
        by_key = np.argsort(got["key"], kind="stable")
        key = got["key"][by_key]
        turns = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        limits = np.append(turns, len(key))
        lo = 0
        while lo < len(key):
            hi = int(limits[max(np.searchsorted(limits, lo + CHUNK, side="right") - 1, np.searchsorted(limits, lo, side="right"))])
            mine = by_key[lo:hi]
            lo = hi
            n, size = len(mine), sizes[mine]
            rows = np.zeros((n, width + 1), np.uint8)
            cells = np.arange(width)[None, :] < size[:, None]
            pick = np.arange(size.sum()) + np.repeat((ends - sizes)[mine] - (np.cumsum(size) - size), size)
            rows[:, :width][cells] = got["bytes"][pick]
            rows[:, width] = size
            doc = got["doc"][mine]
            order = np.lexsort((doc, rows.view(f"V{width + 1}").reshape(-1).argsort(kind="stable").argsort(kind="stable")))
            kind = np.unique(rows.view(f"V{width + 1}").reshape(-1), return_inverse=True)[1].reshape(-1)
            order = np.lexsort((doc, kind))
            fresh = np.concatenate([[True], kind[order][1:] != kind[order][:-1]])
            first = order[fresh]              # a row of each distinct segment, in its smallest document
            lowest = doc[first]
            later = doc > lowest[kind]
            start = np.where(later, 0, 1 << 30)
            stop = np.where(later, size, -1)
            keys = got["key"][mine][first]
            _, group, members = np.unique(keys, return_inverse=True, return_counts=True)
            several = np.flatnonzero(members[group] > 1)  # anchors of more than one distinct segment
            if len(several):
                a, b = _covered(rows[first[several], :width], size[first[several]], lowest[several], length)
                a_of, b_of = np.full(len(first), 1 << 30), np.full(len(first), -1)
                a_of[several], b_of[several] = a, b
                start = np.where(later, start, a_of[kind])
                stop = np.where(later, stop, b_of[kind])
            some = np.flatnonzero(start < stop)
            base = got["start"][mine][some].astype(np.int64)
            spans.append((doc[some], got["mark"][mine][some], base + start[some], base + stop[some]))
        doc, mark, start, stop = (np.concatenate(x) for x in zip(*spans))
        return pa.table({"doc": pa.array(doc), "mark": pa.array(mark.astype(np.int64)),
                         "start": pa.array(start.astype(np.int32)), "stop": pa.array(stop.astype(np.int32))})
    return run


# -- step 3: cutting --------------------------------------------------------------

def merge_spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal runs (touching spans are one run)."""
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    fresh = np.concatenate([[True], starts[1:] > stops[:-1]])
    last = np.append(np.flatnonzero(fresh)[1:], len(starts)) - 1
    return starts[fresh], stops[last]


def _cut_fields(as_text: bool) -> list[T.StructField]:
    return [T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
            T.StructField("kept", T.StringType() if as_text else T.BinaryType())]


def _apply(length: int, as_text: bool):
    def run(batch):
        column = {n: batch.column(batch.schema.get_field_index(n)) for n in ("raw", "copy", "spans")}
        raws, copies = column["raw"].to_pylist(), column["copy"].to_pylist()
        bounds = column["spans"].to_pylist()
        removed, runs, kept = [], [], []
        for raw, copy, spans in zip(raws, copies, bounds):
            if copy and len(raw) >= length:
                spans = [{"start": 0, "stop": len(raw)}]
            if not spans:
                removed.append(0)
                runs.append(0)
                kept.append(raw)
                continue
            a, b = merge_spans(np.array([s["start"] for s in spans]), np.array([s["stop"] for s in spans]))
            removed.append(int((b - a).sum()))
            runs.append(len(a))
            cuts = zip([0, *b.tolist()], [*a.tolist(), len(raw)])
            kept.append(b"".join(raw[x:y] for x, y in cuts))
        rest = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
        return [pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), rest]
    return run


def remove_repeats(docs: DataFrame, min_bytes: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   as_text: bool = False) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans (maximal removed runs) and
    kept (the remaining bytes, or with ``as_text`` their text: a character
    that loses some of its bytes goes as a whole).

    Removed is every byte covered by a string of ``min_bytes`` bytes that also
    starts in a document with a smaller id, judged on the texts as given;
    strings never cross documents.  NULL text counts as empty; texts shorter
    than ``min_bytes`` lose nothing.  A NULL id comes after all others.  Rows
    of one id take nothing from each other.  An empty table gives an empty
    one; columns of the new names are replaced.
    """
    spark = docs.sparkSession
    new = ("n_bytes", "n_removed", "n_spans", "kept")
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new])
    own = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    # the text goes through the shuffles once, as its bytes
    kind = docs.select(text_col).schema[0].dataType
    text = text_col if text_col in own else next((c for c in own if c.lower() == text_col.lower()), None)
    plain = {c for c in own if c != text}
    given = F.when(~F.col("no_text"), F.col("raw").cast("string").cast(kind))
    base = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items() if c in plain],
                       F.col(text_col).isNull().alias("no_text"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc"), raw.alias("raw"),
                       F.unhex(F.md5(raw)).alias("key"))
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc"), F.col(text_col).alias("text"))
    narrow = written_step(base.select("doc", "key", F.octet_length("raw").cast("long").alias("n_bytes"))
                          .groupBy("key").agg(F.min("doc").alias("doc"), F.sum("n_bytes").alias("n_bytes")), "repeat-texts")
    total = narrow.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    expected = max(1, 2 * total // (min_bytes - GRAM + 2))
    parts = max(8, -(-expected // ANCHORS_A_PART))
    hot_from = max(HOT_LEAST, expected // HOT_SHARE)

    found = written_step(texts.select("doc", "text").mapInArrow(_find_anchors(min_bytes, parts), _ANCHOR_ROWS)
                         .groupBy("part").applyInArrow(_shared_anchors(hot_from), _CANDIDATES), "repeat-anchors")
    # at most HOT_SHARE (2 * HOT_SHARE with repeats of the rounding) anchors reach the threshold
    hot_grams = np.array(sorted(r.hot for r in found.where("hot >= 0").select("hot").toLocalIterator()), np.int64)

    one_each = narrow.select("key", "doc")
    places = (found.where("hot < 0").join(one_each.select("doc").distinct(), "doc", "left_semi")
              .groupBy("doc").agg(F.collect_list("pos").alias("places")))
    mark = F.crc32("key")
    wanted = (base.where(F.octet_length("raw") >= min_bytes)
              .select("doc", "key", F.col("raw").cast("string").alias("text"))
              .join(places, "doc").withColumn("mark", mark).select("doc", "mark", "text", "places"))
    spans = written_step(wanted.mapInArrow(_send_segments(min_bytes, parts, hot_grams), _SEGMENT_ROWS)
                         .groupBy("part").applyInArrow(_repeat_spans(min_bytes), _SPANS).distinct(), "repeat-spans")

    per_text = (spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
                .join(one_each.withColumn("mark", mark), ["doc", "mark"], "right")
                .select("key", F.col("doc").alias("first_doc"), "spans"))
    joined = base.join(per_text, "key", "left").withColumn("copy", F.col("doc") > F.col("first_doc"))
    cut = add_columns(joined.select(*[own[c] for c in own if c in plain], "no_text", "raw", "copy", "spans"), _cut_fields(as_text),
                      _apply(min_bytes, as_text))
    return cut.select(*[(F.col(n) if c in plain else given).alias(c) for c, n in own.items()],
                      F.octet_length("raw").cast("long").alias("n_bytes"), "n_removed", "n_spans", "kept")


def remove_repeated_text(docs: DataFrame, min_bytes: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeats cut out of their texts; a character that loses
    some of its bytes goes as a whole.  NULL texts become empty."""
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}  # free of clashes with the new columns
    cut = remove_repeats(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]), min_bytes, own[id_col],
                         own[text_col], as_text=True)
    return cut.select(*[F.col("kept" if c == text_col else n).alias(c) for c, n in own.items()])
