"""Largest-inner-product search by collision-counting hashing (operator 1).

Vectors get one more component so that all of a block have the block's largest
norm; then a larger inner product with a query is a smaller distance to it.  A
block holds vectors of about one norm, so that component stays small.  Each of
``PROJECTIONS`` random lines orders a block's vectors in one sorted array.  A
query opens a window around its own place on every line; the windows widen by
a constant factor (virtual rehashing) and a vector inside the windows of
enough lines is verified, until enough are.  All verified vectors are ranked by
their exact inner products in double precision.

The rows are dealt into blocks of bounded size.  Every query block meets every
vector block, so no block holds more than its share, and the nearest of each
pair of blocks are merged by query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .frames import written

PROJECTIONS = 96      # sorted arrays a block
COLLISIONS = 78       # windows that must hold a vector before it is verified
FIRST_WINDOW = 1.0    # half width of a block's first query, in units of the projections' spread
WIDEN = 1.06          # factor of each virtual rehashing
VERIFY_SHARE = 0.12   # share of a block that is verified before a query stops,
VERIFY_LEAST = 600    # and at least so many times the block allows
VECTORS_A_BLOCK = 16_384  # on average; at most 65,535 by the places' type
QUERIES_A_BLOCK = 8_192
NORM_STEP = 1.25      # largest norm of a block over its smallest, at most,
NORM_RANGES = 48      # but for the last of so many ranges, which holds all smaller ones

_FOUND = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("vec_id", T.LongType()),
                       T.StructField("score", T.DoubleType())])


def usable(vector: Column) -> Column:
    """Vectors that take part: no NULL, no NaN or infinite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    listed = column.combine_chunks()
    return np.asarray(listed.flatten(), np.float64).reshape(len(listed), -1)


class Index:
    """Sorted projections of one block of vectors."""

    def __init__(self, vectors: np.ndarray, longest: float):
        self.vectors = vectors
        missing = np.sqrt(np.maximum(0.0, longest ** 2 - (vectors ** 2).sum(axis=1)))
        lines = np.random.default_rng(17).standard_normal((vectors.shape[1] + 1, PROJECTIONS))
        self.lines = lines[:-1]
        places = vectors @ self.lines + missing[:, None] * lines[-1]
        order = np.argsort(places, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(places.T, order, axis=1)
        self.position = np.empty(order.shape, np.uint16)  # of each vector in each sorted array
        np.put_along_axis(self.position, order, np.arange(len(vectors), dtype=np.uint16)[None, :], axis=1)
        self.longest = longest
        self.half = FIRST_WINDOW * (float(places.std()) or 1.0)

    def candidates(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """At least ``wanted`` vectors (or all) whose places lie within the
        query's windows on ``COLLISIONS`` lines.

        Widening starts a step below the width that the block's query before
        needed; queries come in the order of their ids, so reruns agree.
        """
        n = len(self.vectors)
        if wanted >= n:
            return np.arange(n)
        # the query at the block's largest norm: the order of inner products stays
        middle = (query * (self.longest / np.linalg.norm(query))) @ self.lines
        half = self.half / WIDEN
        while True:
            low = np.array([np.searchsorted(s, m - half) for s, m in zip(self.sorted, middle)])
            high = np.array([np.searchsorted(s, m + half, side="right") for s, m in zip(self.sorted, middle)])
            # inside [low, high): one unsigned comparison, as places before low wrap around
            hits = np.zeros(n, np.uint8)
            for at, a, width in zip(self.position, low.astype(np.uint16), (high - low).astype(np.uint16)):
                hits += (at - a) < width
            found = np.flatnonzero(hits >= COLLISIONS)
            if len(found) >= wanted:
                self.half = half
                return found
            half *= WIDEN


def _search(k: int):
    def run(key, queries: pa.Table, vectors: pa.Table) -> pa.Table:
        ids, out = [], []
        if queries.num_rows and vectors.num_rows:
            queries = queries.sort_by([("vec_id", "ascending")])
            matrix, own = _matrix(vectors.column("vector")), _matrix(queries.column("vector"))
            vec_id = vectors.column("vec_id").to_numpy()
            index = Index(matrix, float(np.linalg.norm(matrix, axis=1).max()))
            wanted = max(VERIFY_LEAST, int(VERIFY_SHARE * len(matrix)))
            for query_id, query in zip(queries.column("vec_id").to_pylist(), own):
                at = index.candidates(query, wanted)
                at = at[vec_id[at] != query_id]
                score = (matrix[at] * query).sum(axis=1)
                best = np.lexsort((vec_id[at], -score))[:k]
                ids += [query_id] * len(best)
                out.append((vec_id[at[best]], score[best]))
        found, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0))
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(found, pa.int64()),
                         "score": pa.array(score, pa.float64())})
    return run


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest found, nearest
    first (largest inner product, ties to the smaller id).

    ``is_query`` says which rows ask (a condition on column vec_id); every row
    but those of the query's own id may be an answer.  Vectors that are NULL,
    zero, or hold a NULL or non-finite component take no part, nor do rows of
    a NULL id; of one id's rows any may answer, once each, and equal query rows
    ask once.  All vectors must have one dimension.  An empty table, or one
    without queries, gives no rows; other columns are ignored.
    """
    ready = written(vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                                   F.col(vector_col).cast("array<double>").alias("vector"))
                    .where(F.col("vec_id").isNotNull() & usable(F.col("vector"))), "neighbours-vectors")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    about = ready.agg(F.max(norm).alias("longest"), F.count(F.when(is_query, 1)).alias("q")).first()
    steps = F.floor((F.log(F.lit(about["longest"])) - F.log(norm)) / math.log(NORM_STEP))
    ready = ready.withColumn("range", F.coalesce(F.least(steps, F.lit(NORM_RANGES - 1)), F.lit(NORM_RANGES - 1)).cast("int"))
    held_by = {r["range"]: r["count"] for r in ready.groupBy("range").count().collect()}  # at most NORM_RANGES rows
    parts = [-(-held_by.get(i, 0) // VECTORS_A_BLOCK) for i in range(NORM_RANGES)]
    starts = [sum(parts[:i]) for i in range(NORM_RANGES)]
    blocks = max(1, sum(parts))
    asks = max(1, -(-about["q"] // QUERIES_A_BLOCK))

    def of_range(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("range") + 1)
    ids = F.xxhash64("vec_id")
    asked = (ready.where(is_query).drop("range").distinct()
             .select("*", F.pmod(ids, F.lit(asks)).alias("ask"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")))
    # the block's hash takes the vector in, so equal ids with many vectors spread as well
    part = F.pmod(F.xxhash64("vec_id", "vector"), of_range([max(1, p) for p in parts]))
    held = ready.select("vec_id", "vector", (of_range(starts) + part).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asks - 1).cast("long"))).alias("ask"))
    found = (asked.groupBy("ask", "block").cogroup(held.groupBy("ask", "block"))
             .applyInArrow(_search(k), _FOUND))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
