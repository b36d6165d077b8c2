"""MinHash near-duplicate groups with sequential Bayesian verification (operator 4).

Documents are sets of word shingles; two are linked when their Jaccard
similarity reaches the threshold.  Equal sets are one *class* from the start.

1.  Every class gets a MinHash signature; classes that agree on all rows of a
    band share a bucket.
2.  In each bucket every class is compared with one pivot.  Signatures are
    compared batch by batch, and a pair is dropped as soon as the posterior
    probability of reaching the threshold falls below ``miss``; survivors are
    verified on the full sets.  Links join classes into components.
3.  Only buckets still holding several components go on.  Their classes meet
    in bounded blocks: all others among themselves and against the pivot's
    component, each pair in the first band it shares.  Classes with a
    surviving partner of another component are verified on full sets, block by
    block, and a block returns links that join components, never all its pairs.

So a large group of copies costs one comparison a member and band, no link
between components is skipped, and no task holds a whole group.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import SpanHasher, ascii_words, doc_slices, lower_ascii, mix, utf8_column
from .components import connected_components
from .frames import add_columns, written_step

BAND_ROWS = 5
BANDS = 40           # a pair at similarity 0.8 shares no band with probability 1e-7
BATCH = 20           # signature values compared between two prunings
MISS = 1e-9          # chosen probability of dropping a pair that reaches the threshold
BLOCK_DOCS = 192     # classes of one side of a block,
BLOCK_SHINGLES = 150_000  # or as many as hold so many shingles


# -- sets and signatures ------------------------------------------------------

def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text: runs of ``words`` words,
    A-Z lower-cased; a shorter text is one shingle; no words, no shingle."""
    data, offsets = utf8_column(column)
    odd = np.random.default_rng(11).integers(1, 1 << 63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for i, j in doc_slices(offsets):
        part = lower_ascii(data[offsets[i]:offsets[j]])
        starts, ends, counts = ascii_words(part, offsets[i:j + 1] - offsets[i])
        hashes = SpanHasher(part).spans(starts, ends)
        n = max(0, len(hashes) - words + 1)
        runs = np.zeros(n, np.uint64)
        for k in range(words):
            runs += hashes[k:k + n] * odd[k]
        runs = mix(runs)
        bounds = np.concatenate([[0], np.cumsum(counts)]).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= words:
                run = np.sort(runs[a:b - words + 1])
                out.append(run[np.concatenate([[True], run[1:] != run[:-1]])])
            elif b > a:
                short = (hashes[a:b] * odd[:b - a]).sum(dtype=np.uint64, keepdims=True)
                out.append(mix(short + np.uint64(b - a)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    n = BANDS * BAND_ROWS
    return rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 31, n, dtype=np.uint32) * 2 + 1


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signature (uint32) of every non-empty set."""
    flips, factors = _permutations()
    out = np.empty((len(sets), len(flips)), np.uint32)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (size < 1 << 18 or end == at):
            size += len(sets[end])
            end += 1
        values = (np.concatenate(sets[at:end]) >> np.uint64(32)).astype(np.uint32)
        firsts = np.cumsum([0] + [len(s) for s in sets[at:end - 1]])
        for k in range(len(flips)):
            out[at:end, k] = np.minimum.reduceat((values ^ flips[k]) * factors[k], firsts)
        at = end
    return out


def _describe(words: int):
    def run(batch):
        sets = shingle_sets(batch.column(batch.schema.get_field_index("text")), words)
        filled = [i for i, s in enumerate(sets) if len(s)]
        keys, sigs, bands = ([None] * len(sets) for _ in range(3))
        if filled:
            full = signatures([sets[i] for i in filled])
            rows = full.astype(np.uint64).reshape(len(filled), BANDS, BAND_ROWS)
            odd = np.random.default_rng(12).integers(1, 1 << 63, BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            band = mix((rows * odd).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            small = full.astype(np.uint16)  # 16 bits of each value are enough to compare
            for n, i in enumerate(filled):
                keys[i], sigs[i], bands[i] = set_key(sets[i]), small[n].tobytes(), band[n].tolist()
        return [pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()),
                pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
    return run


_DESCRIBED = [T.StructField("n_shingles", T.LongType()), T.StructField("key", T.BinaryType()),
              T.StructField("sig", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]


# -- sequential Bayesian comparison -------------------------------------------

def prune_limits(values: int, percent: int, miss: float, batch: int) -> list[tuple[int, int]]:
    """(compared, least matches to go on) after each batch.

    With a uniform prior, m matches of n leave a Beta(m+1, n-m+1) posterior of
    the similarity; its mass at or above t is P(Binomial(n+1, t) <= m).
    """
    t = percent / 100
    out = []
    for n in range(batch, values + 1, batch):
        mass, least = 0.0, 0
        for m in range(n + 1):
            mass += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if mass >= miss:
                least = m
                break
        out.append((n, least))
    return out


def surviving(a: np.ndarray, b: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of two signature arrays stay possible after all batches."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    done = 0
    for n, least in limits:
        matches += (a[alive, done:n] == b[alive, done:n]).sum(axis=1, dtype=np.int32)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
        if not len(alive):
            break
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def _sig_rows(column) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(-1, BANDS * BAND_ROWS)


# -- exact verification in blocks ---------------------------------------------

def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (len(a), len(b)) if len(a) <= len(b) else (len(b), len(a))
    if 100 * small < percent * large:
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Shared shingles of every two sets of one block (bounded by the block)."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((n, n), np.float64)
    width = 4096
    bounds = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        has = np.zeros((n, width), np.float32)
        has[owner[lo:hi], column[lo:hi] - k * width] = 1
        out += has @ has.T
    return out.astype(np.int64)


_EDGE = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])


def _verify_block(words: int, percent: int):
    """Links between the components of one block, by label (columns key, label,
    side, text); sides 0 meet each other and side 1, sides 1 only sides 0."""
    def run(table: pa.Table) -> pa.Table:
        keys, labels = table.column("key").to_pylist(), table.column("label").to_pylist()
        side = np.array(table.column("side").to_pylist())
        sets = shingle_sets(table.column("text").combine_chunks(), words)
        # a text must have its class's set
        own = [i for i, s in enumerate(sets) if len(s) and set_key(s) == keys[i]]
        out_a, out_b = [], []
        if len(own) > 1:
            sets, side = [sets[i] for i in own], side[own]
            keys, labels = [keys[i] for i in own], [labels[i] for i in own]
            sizes = np.array([len(s) for s in sets])
            shared = common_counts(sets)
            linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
            linked &= (side[:, None] == 0) | (side[None, :] == 0)
            root = {x: x for x in labels}

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x
            for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(linked, 1)))):
                x, y = find(labels[i]), find(labels[j])
                if x != y:
                    root[x] = y
                    out_a.append(labels[i])
                    out_b.append(labels[j])
        return pa.table({"a": pa.array(out_a, pa.binary()), "b": pa.array(out_b, pa.binary())})
    return run


_SHORTLIST = T.StructType([T.StructField("block", T.LongType()), T.StructField("key", T.BinaryType()),
                           T.StructField("label", T.BinaryType()), T.StructField("side", T.IntegerType())])


def _shortlist_block(limits: list[tuple[int, int]]):
    """Classes of one block that keep a partner of another component after the
    sequential comparison, counting each pair in the first band it shares."""
    def run(table: pa.Table) -> pa.Table:
        sig = _sig_rows(table.column("sig"))
        side = np.array(table.column("side").to_pylist())
        label = np.unique(np.array([x.hex() for x in table.column("label").to_pylist()]), return_inverse=True)[1]
        band = table.column("band")[0].as_py()
        wanted = np.zeros(len(sig), bool)
        ones = np.flatnonzero(side == 0)
        for i in ones.tolist():
            others = np.flatnonzero((label != label[i]) & ((side == 1) | (np.arange(len(sig)) > i)))
            if not len(others):
                continue
            mine = np.broadcast_to(sig[i], (len(others), sig.shape[1]))
            others = others[surviving(mine, sig[others], limits)]
            same = (sig[others] == sig[i]).reshape(len(others), BANDS, BAND_ROWS).all(axis=2)
            others = others[same.argmax(axis=1) == band]
            if len(others):
                wanted[i] = True
                wanted[others] = True
        table = table.select(_SHORTLIST.fieldNames()).filter(pa.array(wanted))
        return table
    return run


# -- the operator ---------------------------------------------------------------

def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = MISS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * common >= percent * union over their
    distinct shingles of ``words`` words (words: runs of bytes other than
    space, tab and line breaks, A-Z lower-cased; fewer words are one shingle).
    ``component_id`` is the smallest id reachable over links; the document of
    that id is kept.  NULL, empty and blank texts have no shingles and are
    linked with nothing.  Texts with equal sets are linked, also under one
    repeated id.  A NULL id is carried: its row joins its group but never names
    it, and a group of NULL ids alone has component NULL.  An empty table gives
    an empty result; other columns are ignored.
    """
    groups = _groups(docs, words, percent, miss, id_col, text_col)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all columns.
    Rows are known by id and text together, so repeated rows stay or go alike."""
    groups = _groups(docs, words, percent, MISS, id_col, text_col)
    kept = written_step(groups.where("kept").select("doc_id", "tie").distinct(), "near-kept")
    tie = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    same = F.col("_own").eqNullSafe(F.col("doc_id")) & (F.col("_tie") == F.col("tie"))
    own = {c: f"_{i}" for i, c in enumerate(docs.columns)}  # free of clashes with the decision's columns
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()],
                       F.col(f"`{id_col}`").cast("long").alias("_own"), tie.alias("_tie"))
    return rows.join(kept, same, "left_semi").select(*[F.col(n).alias(c) for c, n in own.items()])


def _groups(docs: DataFrame, words: int, percent: int, miss: float, id_col: str, text_col: str) -> DataFrame:
    """``near_duplicates`` with ``tie``, a hash of each row's text."""
    limits = prune_limits(BANDS * BAND_ROWS, percent, miss, BATCH)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tied = source.withColumn("tie", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = written_step(add_columns(tied, _DESCRIBED, _describe(words)).drop("text"), "near-signatures")
    classes = written_step(
        rows.where("key IS NOT NULL").groupBy("key")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie")).alias("of"),
             F.min(F.struct("sig", "bands", "n_shingles")).alias("x"))
        .select("key", "of.doc_id", "of.tie", "x.*"), "near-classes")

    # buckets of more than one class, each with a pivot
    banded = classes.select("key", F.posexplode("bands").alias("band", "bucket"))
    buckets = (banded.groupBy("bucket", "band").agg(F.min("key").alias("pivot"), F.max("key").alias("last"))
               .where("pivot < last").drop("last"))
    members = written_step(banded.join(buckets, ["bucket", "band"]), "near-buckets")

    pairs = members.where("key <> pivot").select("key", "pivot").distinct()
    sigs = classes.select("key", "sig")
    compared = (pairs.join(sigs, "key")
                .join(sigs.select(F.col("key").alias("pivot"), F.col("sig").alias("pivot_sig")), "pivot"))

    def prune(batches):
        for batch in batches:
            if batch.num_rows:
                keep = surviving(_sig_rows(batch.column("sig")), _sig_rows(batch.column("pivot_sig")), limits)
                yield batch.select(["key", "pivot"]).filter(pa.array(keep))

    survivors = written_step(compared.select("key", "pivot", "sig", "pivot_sig")
                             .mapInArrow(prune, "key binary, pivot binary"), "near-survivors")

    def texts(keys: DataFrame) -> DataFrame:
        """A text of each class: of its smallest id, known by id and text hash."""
        of = classes.select("key", F.col("doc_id").alias("of_id"), "tie").join(keys.distinct(), "key", "left_semi")
        mine = (of["tie"] == tied["tie"]) & of["of_id"].eqNullSafe(tied["doc_id"])
        return of.join(tied, mine).select("key", "text").dropDuplicates(["key"])

    needed = written_step(texts(survivors.select("key").union(survivors.select("pivot"))), "near-texts")

    def verify(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.select(["a", "b"]).filter(pa.array(_exact(batch, words, percent)))

    stars = (survivors.join(needed, "key").withColumnRenamed("text", "text_a")
             .join(needed.select(F.col("key").alias("pivot"), F.col("text").alias("text_b")), "pivot")
             .select(F.col("key").alias("a"), F.col("pivot").alias("b"), "text_a", "text_b"))
    links = written_step(stars.mapInArrow(verify, _EDGE).distinct(), "near-links")
    labels = connected_components(links)

    # buckets that still hold several components
    marked = (members.join(labels.withColumnRenamed("node", "key"), "key", "left")
              .withColumn("label", F.coalesce("label", "key")))
    marked = written_step(marked.join(classes.select("key", "n_shingles"), "key"), "near-marked")
    open_buckets = (marked.groupBy("bucket", "band")
                    .agg(F.min("label").alias("low"), F.max("label").alias("high"),
                         F.max(F.when(F.col("key") == F.col("pivot"), F.col("label"))).alias("main"))
                    .where("low < high").drop("low", "high"))
    sided = (marked.join(open_buckets, ["bucket", "band"])
             .withColumn("side", F.when(F.col("label") == F.col("main"), 1).otherwise(0)))
    main, other = F.col("side") == 1, F.col("side") == 0

    def chunks(side: Column) -> Column:
        docs_, shingles_ = F.count_if(side), F.coalesce(F.sum(F.when(side, F.col("n_shingles"))), F.lit(0))
        return F.ceil(F.greatest(docs_ / BLOCK_DOCS, shingles_ / BLOCK_SHINGLES)).cast("int")

    counts = sided.groupBy("bucket", "band").agg(chunks(other).alias("others"), chunks(main).alias("mains"))
    dealt = sided.join(counts, ["bucket", "band"])
    chunk = F.pmod(F.xxhash64("key"), F.when(F.col("side") == 0, F.col("others")).otherwise(F.col("mains")))
    # a block is two chunks: (i, j) with i <= j of the others, or (i, main j)
    blocks_of_other = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("others") - 1),
                    lambda o: F.concat_ws("/", F.least(o, F.col("chunk")), F.greatest(o, F.col("chunk")))),
        F.when(F.col("mains") > 0, F.transform(F.sequence(F.lit(0), F.col("mains") - 1),
                                               lambda m: F.concat_ws("/", F.col("chunk"), F.lit("m"), m)))
        .otherwise(F.array().cast("array<string>")))
    blocks_of_main = F.transform(F.sequence(F.lit(0), F.col("others") - 1),
                                 lambda o: F.concat_ws("/", o, F.lit("m"), F.col("chunk")))
    blocks = (dealt.withColumn("chunk", chunk.cast("int"))
              .withColumn("block", F.explode(F.when(F.col("side") == 0, blocks_of_other).otherwise(blocks_of_main)))
              .select(F.xxhash64("bucket", "band", "block").alias("block"), "band", "key", "label", "side"))
    shortlist = written_step(
        blocks.join(sigs, "key").groupBy("block").applyInArrow(_shortlist_block(limits), _SHORTLIST),
        "near-shortlist")
    more = (shortlist.join(texts(shortlist.select("key")), "key").groupBy("block")
            .applyInArrow(_verify_block(words, percent), _EDGE))
    above = connected_components(written_step(more.distinct(), "near-more-links"))

    # components back to documents: a class's component, or the one that it was joined to
    named = (classes.select("key", "doc_id").join(labels.withColumnRenamed("node", "key"), "key", "left")
             .select("key", "doc_id", F.coalesce("label", "key").alias("node")).join(above, "node", "left")
             .select("key", "doc_id", F.coalesce("label", "node").alias("label")))
    lowest = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    component = named.select("key", "label").join(lowest, "label").select("key", "component_id")
    return (rows.select("doc_id", "tie", "n_shingles", "key").join(component, "key", "left")
            .select("doc_id", "tie", "n_shingles",
                    F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def _exact(batch: pa.RecordBatch, words: int, percent: int) -> np.ndarray:
    """Which rows (a, text_a, b, text_b) are links; rows that repeat a pivot
    reuse its set."""
    at = {n: batch.schema.get_field_index(n) for n in ("a", "b", "text_a", "text_b")}
    keys_a, keys_b = batch.column(at["a"]).to_pylist(), batch.column(at["b"]).to_pylist()
    first = {k: i for i, k in reversed(list(enumerate(keys_b)))}
    pivots = dict(zip(first, shingle_sets(batch.column(at["text_b"]).take(pa.array(list(first.values()))), words)))
    out = np.zeros(batch.num_rows, bool)
    for i, mine in enumerate(shingle_sets(batch.column(at["text_a"]), words)):
        other = pivots[keys_b[i]]
        out[i] = (_linked(mine, other, percent) and set_key(mine) == keys_a[i] and set_key(other) == keys_b[i])
    return out
