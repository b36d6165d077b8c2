"""Ranked lexical search by dense blocked multiplication (operator 12).

One pass over the documents keeps, of every whole text, its length and the
counts of the terms that occur in a query at all; statistics are sums over
these vectors.  A second pass multiplies tiles: the queries' weights on a
compact vocabulary tile (the terms of a few queries that the documents at hand
hold) times the documents' impacts, as float64 BLAS products.  Weights and
impacts are whole numbers; a tile is split until its sums stay below 2**53, so
every product is exact, and the sums are added as 64-bit integers.

Each task keeps the best k of its documents per query, ties by id, and what
it keeps goes through two rounds of top-k by query.  Queries come in blocks of
a bounded number of bytes, each of which is one such search over all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .arrays import ragged
from .frames import add_columns, release_memory, written

BLOCK_BYTES = 1 << 20  # of queries searched together: bounds their vocabulary and its broadcast
LONG_BYTES = 1 << 20  # of a text split into words at once
QUERY_TILE, DOC_TILE, TERM_TILE = 256, 512, 2048
EXACT = 1 << 53  # float64 holds every whole number up to here
SCALE = 1000000  # no impact is larger
MERGE_BUCKETS = 16

# Everything but digits, letters and non-ASCII bytes parts terms; A-Z become a-z.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a whole text, some megabyte at a time."""
    data = (text or "").encode().translate(_TERM_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + LONG_BYTES)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_terms(text: str | None) -> Counter:
    counts = Counter()
    for words in terms_of(text):
        counts.update(words)
    return counts


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n (terms of the whole text), terms (indices in the vocabulary) and their counts."""
    lists = T.ArrayType(T.IntegerType())
    fields = [T.StructField("n", T.LongType()), T.StructField("terms", lists), T.StructField("counts", lists)]

    def vectors(batch: pa.RecordBatch) -> list[pa.Array]:
        n, size, terms, counts = [], [], [], []
        for text in batch.column(batch.schema.get_field_index("text")):
            found = count_terms(text.as_py())
            n.append(found.total())
            held = found.keys() & vocabulary.keys() if len(found) > len(vocabulary) else [t for t in found if t in vocabulary]
            terms += [vocabulary[t] for t in held]
            counts += [found[t] for t in held]
            size.append(len(held))
        return [pa.array(n, pa.int64()), ragged(np.array(terms, np.int32), np.array(size, np.int64), pa.int32()),
                ragged(np.array(counts, np.int32), np.array(size, np.int64), pa.int32())]

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return add_columns(narrow, fields, vectors).drop("text")


def exact_product(weights: np.ndarray, impacts: np.ndarray) -> np.ndarray:
    """weights (queries x terms) times impacts (documents x terms), whole
    numbers, exactly: BLAS where every sum stays below 2**53, halves of the
    terms otherwise, 64-bit integers for a single term beyond it."""
    if not weights.size or int(weights.sum(axis=1).max()) * SCALE < EXACT:
        return (weights.astype(np.float64) @ impacts.T.astype(np.float64)).astype(np.int64)
    if weights.shape[1] == 1:
        return weights * impacts.T
    half = weights.shape[1] // 2
    return exact_product(weights[:, :half], impacts[:, :half]) + exact_product(weights[:, half:], impacts[:, half:])


class _Best:
    """The best k (score, document) of each query of a tile, equal scores by id, NULL ids last."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.zeros(queries, np.int64)  # a score below a query's floor cannot enter
        self.query = np.zeros(0, np.int64)
        self.score, self.id, self.null = self.query.copy(), self.query.copy(), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        floor = self.floor
        if scores.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k])
        query, doc = np.nonzero((scores >= floor[:, None]) & (scores > 0))
        if not len(query):
            return
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, scores[query, doc]])
        id_, null = np.concatenate([self.id, ids[doc]]), np.concatenate([self.null, null[doc]])
        order = np.lexsort((id_, null, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = order[rank < self.k]
        self.query, self.score, self.id, self.null = query[rank < self.k], score[keep], id_[keep], null[keep]
        full = self.query[rank[rank < self.k] == self.k - 1]
        self.floor[full] = self.score[rank[rank < self.k] == self.k - 1]


def _search(batches: Iterator[pa.RecordBatch], queries: list[tuple[np.ndarray, np.ndarray]], n_docs: int, n_terms: int,
            k: int) -> Iterator[pa.RecordBatch]:
    tiles = [queries[i:i + QUERY_TILE] for i in range(0, len(queries), QUERY_TILE)]
    flat = []  # of each tile: query, term and weight of its entries
    for tile in tiles:
        rows = np.repeat(np.arange(len(tile)), [len(t) for t, _ in tile])
        flat.append((rows, np.concatenate([t for t, _ in tile]), np.concatenate([w for _, w in tile])))
    best = [_Best(len(tile), k) for tile in tiles]
    for batch in batches:
        ids = batch.column(0)
        null, ids = pc.is_null(ids).to_numpy(zero_copy_only=False), pc.fill_null(ids, 0).to_numpy()
        length = batch.column(1).to_numpy()
        held = batch.column(2)
        ends = held.offsets.to_numpy()
        terms, counts = held.values.to_numpy(), batch.column(3).values.to_numpy()
        for i in range(0, len(ids), DOC_TILE):
            j = min(i + DOC_TILE, len(ids))
            doc = np.repeat(np.arange(j - i), np.diff(ends[i:j + 1]))
            term, tf = terms[ends[i]:ends[j]], counts[ends[i]:ends[j]].astype(np.int64)
            m = 75 + 25 * length[i:j] * n_docs // max(n_terms, 1)
            impact = 1000000000 * tf // (1000 * tf + 12 * m[doc])
            for tile, (rows, wanted, weight), kept in zip(tiles, flat, best):
                present = np.intersect1d(wanted, term)  # the compact vocabulary
                scores = np.zeros((len(tile), j - i), np.int64)
                for c in range(0, len(present), TERM_TILE):
                    some = present[c:c + TERM_TILE]
                    w, d = np.zeros((len(tile), len(some)), np.int64), np.zeros((j - i, len(some)), np.int64)
                    for matrix, row, column, value in ((w, rows, wanted, weight), (d, doc, term, impact)):
                        at = np.minimum(np.searchsorted(some, column), len(some) - 1)
                        hit = some[at] == column
                        matrix[row[hit], at[hit]] = value[hit]
                    scores += exact_product(w, d)
                kept.add(scores, ids[i:j], null[i:j])
        release_memory()
    for t, kept in enumerate(best):
        yield pa.RecordBatch.from_arrays(
            [pa.array((kept.query + t * QUERY_TILE).astype(np.int32)), pa.array(kept.id, pa.int64(), mask=kept.null),
             pa.array(kept.score)], names=["query", "doc", "score"])


def _rank_block(docs: DataFrame, block: list, id_type: T.DataType, k: int, id_col: str, text_col: str) -> DataFrame:
    """Ranking of the (item id, text) of one block, both from the driver."""
    spark = docs.sparkSession
    counted = [count_terms(text) for _, text in block]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    vectors = written(_vectors(docs, vocabulary, id_col, text_col), "search-vectors")
    total = vectors.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        df[row[0]] = row[1]
    weight = np.array([math.floor(1000 * math.log((2 * total[0] + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    queries = []
    for found in counted:
        terms = np.array(sorted(vocabulary[t] for t in found), np.int64)
        times = dict(zip((vocabulary[t] for t in found), found.values()))
        queries.append((terms, np.array([times[t] for t in terms.tolist()], np.int64) * weight[terms]))
    best = (vectors.where(F.size("terms") > 0).select("id", "n", "terms", "counts")
            .mapInArrow(lambda it: _search(it, queries, total[0], total[1], k), "query INT, doc LONG, score LONG"))
    order = [F.desc("score"), F.col("doc").asc_nulls_last()]
    best = best.withColumn("_bucket", F.spark_partition_id() % MERGE_BUCKETS)
    for keys in (["query", "_bucket"], ["query"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)],
                                  T.StructType([T.StructField("query", T.IntegerType()), T.StructField("item_id", id_type)]))
    return best.join(F.broadcast(names), "query").select("item_id", "rank", F.col("doc").alias("doc_id"), "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
                   item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of each item: item_id, rank (from 1,
    highest first, equal scores by ascending id), doc_id (long), score (long).

    Terms are runs of ASCII digits, letters (A-Z lower-cased) and non-ASCII
    characters of the whole text.  Of N documents with terms, L terms in all:
    a term in df documents weighs floor(1000 * ln((2N + 2) / (2df + 1))); tf
    occurrences in a document of n terms count 10**9 * tf div (1000 tf + 12 m),
    m = 75 + 25 n N div L.  An item sums weight times impact over its terms,
    repeats included; only scores above 0 are returned.

    NULL and empty texts have no terms, are in no ranking and count nowhere.
    Every document row is ranked, so equal rows come one after the other; NULL
    ids come after others of their score.  Item rows of equal id and text are
    one item; rows of one id and different texts are ranked apart.  Empty
    tables give no rows; other columns are not looked at.
    """
    texts = (items.select(F.col(f"`{item_id_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
             .where(F.col("text").isNotNull()).distinct())
    size = texts.agg(F.sum(F.octet_length("text") + F.lit(64))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    ranked = None
    for b in range(blocks):
        block = [tuple(r) for r in texts.where(number == b).collect()]  # about BLOCK_BYTES, or one longer item
        if block:
            some = _rank_block(docs, sorted(block, key=str), texts.schema["item_id"].dataType, k, id_col, text_col)
            ranked = some if ranked is None else ranked.union(some)
    if ranked is None:
        return texts.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", texts.schema["item_id"].dataType), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return ranked
