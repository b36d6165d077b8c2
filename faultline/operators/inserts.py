"""Constraints checked on new rows alone, as a database does on insert.

``quality.enforce`` counts every key of every table again.  Here each key that
a constraint needs (a table's PRIMARY KEY or UNIQUE columns, the parent key of
a FOREIGN KEY) has a *key index*: the bare keys in partitions by key hash.  A
check of new rows reads the new rows and those index partitions that their
keys fall into; no old row of a table is read.  Accepted rows add their keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .quality import ROW_LEVEL, Constraint, row_violation

PART, BATCH = "_part", "_batch"


@dataclass(frozen=True)
class KeyIndex:
    """The keys ``columns`` of a table at ``path``, in ``partitions`` folders.

    Every key carries the name of the load it came with; a load that is
    repeated after a crash does not collide with its own keys."""

    path: str
    columns: tuple[str, ...]
    partitions: int = 256

    def _keys(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Whole keys of ``df`` under the index's names, with their partition; keys with a NULL are none."""
        filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        named = df.filter(filled).select(*[F.col(c).alias(k) for c, k in zip(columns, self.columns)])
        return named.withColumn(PART, F.pmod(F.xxhash64(*self.columns), F.lit(self.partitions)).cast("int"))

    def add(self, df: DataFrame, batch: str = "first", columns: Sequence[str] | None = None) -> None:
        """Append the keys of ``df``."""
        keys = self._keys(df, columns or self.columns).withColumn(BATCH, F.lit(batch)).hint("rebalance", PART)
        keys.write.mode("append").partitionBy(PART).parquet(self.path)

    def stored(self, spark: SparkSession, parts: Sequence[int]) -> DataFrame:
        """The indexed keys of some partitions; the scan lists only their folders."""
        return spark.read.parquet(self.path).filter(F.col(PART).isin(list(parts)))

    def counted(self, new: DataFrame, columns: Sequence[str], batch: str | None = None) -> DataFrame:
        """Keys of ``new`` with their rows (_n) and whether the index has them
        (_known), not counting keys that came with ``batch``."""
        spark = new.sparkSession
        shared_dir(spark)
        keys = self._keys(new, columns).groupBy(*self.columns, PART).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
        parts = [r[0] for r in keys.select(PART).distinct().collect()]  # at most self.partitions
        if not parts:
            return keys.withColumn("_known", F.lit(False))
        there = self.stored(spark, parts)
        if batch is not None:
            there = there.filter(F.col(BATCH) != batch)
        on = [*self.columns, PART]
        return keys.join(there.select(*on).distinct().withColumn("_known", F.lit(True)), on, "left").withColumn(
            "_known", F.coalesce("_known", F.lit(False)))


def build_index(df: DataFrame, columns: str | Sequence[str], path: str, partitions: int = 256) -> KeyIndex:
    """Index the keys of a table that is there already."""
    index = KeyIndex(path.rstrip("/"), (columns,) if isinstance(columns, str) else tuple(columns), partitions)
    index.add(df)
    return index


def _needed(c: Constraint) -> tuple[str, tuple[str, ...]]:
    return (c.arg[0], tuple(c.arg[1])) if c.kind == "foreign_key" else (c.table, tuple(c.columns))


def insert_report(new: DataFrame, constraints: Sequence[Constraint],
                  indexes: Mapping[tuple[str, tuple[str, ...]], KeyIndex], batch: str | None = None) -> DataFrame:
    """One row per constraint on the table of ``new``: kind, columns and how
    much of ``new`` breaks it.

    ``indexes``: (table, key columns) -> index, one for every key looked up; a
    missing one is an error.  Counted are rows for NOT NULL, CHECK and length,
    rows without a parent for a foreign key (NULL has none to miss), and keys
    that occur twice in ``new`` or are indexed already for PRIMARY KEY and
    UNIQUE (for UNIQUE keys with a NULL never collide; a PRIMARY KEY with a
    NULL is NOT NULL's affair).
    """
    constraints = list(constraints)
    if not constraints:
        raise ValueError("no constraint given")
    if missing := sorted({str(_needed(c)) for c in constraints if c.kind not in ROW_LEVEL} - {str(k) for k in indexes}):
        raise ValueError("keys without an index: " + ", ".join(missing))
    by_row = [F.count_if(row_violation(c)).alias(str(i)) for i, c in enumerate(constraints) if c.kind in ROW_LEVEL]
    parts = []
    if by_row:
        ids = [str(i) for i, c in enumerate(constraints) if c.kind in ROW_LEVEL]
        parts.append(new.agg(*by_row).unpivot([], ids, "_id", "violations"))
    for i, c in enumerate(constraints):
        if c.kind in ROW_LEVEL:
            continue
        keys = indexes[_needed(c)].counted(new, c.columns, batch)
        broken = (F.sum(F.when(~F.col("_known"), F.col("_n"))) if c.kind == "foreign_key"
                  else F.count_if(F.col("_known") | (F.col("_n") > 1)))
        parts.append(keys.agg(F.coalesce(broken, F.lit(0)).cast("long").alias("violations")).select(F.lit(str(i)).alias("_id"), "violations"))
    counts = reduce(DataFrame.unionByName, parts)
    listed = new.sparkSession.createDataFrame([(str(i), c.kind, ",".join(c.columns)) for i, c in enumerate(constraints)],
                                              "_id string, kind string, columns string")
    return listed.join(counts, "_id").drop("_id")


def insert_checked(new: DataFrame, table_path: str, constraints: Sequence[Constraint],
                   indexes: Mapping[tuple[str, tuple[str, ...]], KeyIndex], table: str, batch: str) -> None:
    """Append ``new`` to the table folder if it breaks none of its
    ``constraints``, else raise ``ValueError`` and change nothing.

    The keys go to the indexes of ``table`` first, then the rows, in one
    committed append: after a crash in between, the load is repeated under the
    same ``batch`` name.
    """
    shared_dir(new.sparkSession)
    new = new.checkpoint(eager=True)  # checked and appended: the same rows
    broken = [r for r in insert_report(new, constraints, indexes, batch).collect() if r["violations"]]
    if broken:
        raise ValueError("constraint violations: " + "; ".join(f"{table}.{r['kind']}({r['columns']}): {r['violations']}" for r in broken))
    for (owner, columns), index in indexes.items():
        if owner == table:
            own = index.stored(new.sparkSession, range(index.partitions)).filter(F.col(BATCH) == batch)
            if own.isEmpty():  # not there from an interrupted run
                index.add(new, batch, columns)
    new.write.mode("append").parquet(table_path)
