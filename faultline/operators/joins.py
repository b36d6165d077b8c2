"""Star-schema joins with a checked broadcast and eager aggregation.

A fact table references dimensions through foreign keys.  Each dimension is
projected to its key and the attributes a query needs, then:

* if it provably holds at most ``broadcast_max_rows`` rows (an exact count,
  all dimensions of a call in one job, one row per task shuffled) it is
  broadcast and joined inside the scan stage - the fact is never shuffled;
* otherwise the fact is first *pre-aggregated* by its foreign keys (a partial
  + final count, so a hot key collapses to one row per task before the
  shuffle) and the much smaller aggregate is joined with a shuffle join.  AQE
  may still turn that join into a broadcast once runtime sizes are known.

Operators downstream aggregate with :class:`Weights`, which reads the count
column when the rows were pre-aggregated and counts rows otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Upper bounds of a side we broadcast without Spark's own size check: rows, and
# the bytes of its values.  Far below Spark's 8 GB limit and executor memory.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 << 20

WEIGHT = "_w"


def _names(x) -> tuple[str, ...]:
    return (x,) if isinstance(x, str) else tuple(x)


def fits(df: DataFrame, max_rows: int | None) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and BROADCAST_MAX_BYTES."""
    return fits_each([df], max_rows)[0]


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values: text and binary by length, others 16 each."""
    size = F.lit(0)
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + F.lit(16)
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            size = size + F.octet_length(F.coalesce(F.to_json(F.struct(F.col(f.name))), F.lit("")))
        else:
            size = size + F.lit(16)
    return size.cast("long")


def fits_each(dfs: Sequence[DataFrame], max_rows: int | None) -> list[bool]:
    """Whether several (dimension) DataFrames are small, in one job: exact row
    counts and value bytes.

    A partial/final aggregate: each task sends one row per input to the final
    one, so no rows move (``limit(n).count()`` would ship up to n rows from
    every task to one partition).  Dimensions are small next to the fact, so
    this pass is cheap relative to the query.
    """
    if not dfs:
        return []
    if max_rows is None or max_rows < 0:
        return [False] * len(dfs)
    parts = [d.select(F.lit(i).alias("_i"), _row_bytes(d).alias("_b")) for i, d in enumerate(dfs)]
    found = {r["_i"]: r for r in reduce(DataFrame.unionAll, parts).groupBy("_i")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("_b").alias("b")).collect()}
    return [i not in found or (found[i]["n"] <= max_rows and found[i]["b"] <= BROADCAST_MAX_BYTES)
            for i in range(len(dfs))]


def checked_broadcast(df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a proven bound of rows and bytes; otherwise
    leave the choice to Spark's size estimate and AQE."""
    return F.broadcast(df) if fits(df, max_rows) else df


@dataclass(frozen=True)
class Dim:
    """A dimension reachable from the fact by an equi-join.

    ``on``: the fact's foreign-key column(s); ``key``: the dimension's key
    column(s) (defaults to the same names); ``columns``: attributes to attach.
    Keys are assumed unique in the dimension, as a primary key is.
    """

    df: DataFrame
    on: str | Sequence[str]
    columns: Sequence[str]
    key: str | Sequence[str] | None = None
    keep_key: bool = False

    def projected(self) -> DataFrame:
        on, key = _names(self.on), _names(self.key or self.on)
        cols = [F.col(k).alias(o) for k, o in zip(key, on)]
        cols += [F.col(c) for c in self.columns if c not in on]
        return self.df.select(*cols)


@dataclass
class Weights:
    """Counting over possibly pre-aggregated rows."""

    weight: str | None = None

    def count(self) -> Column:
        if self.weight is None:
            return F.count(F.lit(1))
        return F.sum(self.weight).cast("long")

    def count_if(self, predicate: Column) -> Column:
        w = F.lit(1) if self.weight is None else F.col(self.weight)
        return F.coalesce(F.sum(F.when(predicate, w).otherwise(F.lit(0))), F.lit(0)).cast("long")


def attach(fact: DataFrame, dims: Sequence[Dim], keep: Sequence[str] = (),
           broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> tuple[DataFrame, Weights]:
    """Join ``dims`` to ``fact`` and return (rows, weights).

    Output columns: ``keep`` (fact columns) + every dimension's ``columns``
    (+ keys with ``keep_key``), and the weight column when pre-aggregated.
    """
    keep = list(keep)
    all_fk = [c for d in dims for c in _names(d.on)]
    needed = list(dict.fromkeys(keep + all_fk))
    df = fact.select(*needed)

    small, large = [], []
    for d, ok in zip(dims, fits_each([d.projected() for d in dims], broadcast_max_rows)):
        (small if ok else large).append(d)

    def drop_keys(frame: DataFrame, d: Dim, still_needed: set[str]) -> DataFrame:
        gone = [k for k in _names(d.on) if k not in keep and k not in still_needed and not d.keep_key]
        return frame.drop(*gone) if gone else frame

    pending_fk = {c for d in large for c in _names(d.on)}
    for i, d in enumerate(small):
        df = df.join(F.broadcast(d.projected()), on=list(_names(d.on)), how="inner")
        later = {c for e in small[i + 1:] for c in _names(e.on)} | pending_fk
        df = drop_keys(df, d, later)

    if not large:
        return df, Weights(None)

    df = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(WEIGHT))
    for i, d in enumerate(large):
        df = df.join(d.projected(), on=list(_names(d.on)), how="inner")
        later = {c for e in large[i + 1:] for c in _names(e.on)}
        df = drop_keys(df, d, later)
        if i + 1 < len(large):
            cols = [c for c in df.columns if c != WEIGHT]
            df = df.groupBy(*cols).agg(F.sum(WEIGHT).alias(WEIGHT))
    return df, Weights(WEIGHT)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where NULL matches NULL (``<=>``), as GROUP BY
    treats NULL keys as one group; the key columns appear once."""
    tmp = {c: f"_ns_{i}" for i, c in enumerate(on)}
    r = right.select(*[F.col(c).alias(tmp[c]) if c in tmp else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(tmp[c])) for c in on])
    return left.join(r, on=cond, how=how).drop(*tmp.values())
