"""Tables dealt over partitions by a hash of their key, merged in place.

``upsert_by_key`` reads and writes a whole table; a load of a few rows into a
large one should not.  A keyed table is a folder with

* ``rows``: the rows, in ``partitions`` partition folders by key hash,
* ``layout``: one row with the schema, the key, the number of partitions and
  the id column,
* ``last_id``: one row per load that gave out ids, the largest given out.

A merge reads the partitions its keys fall into, once, and overwrites those;
the others keep their files.  Merging the same rows again changes nothing, so
a load that was interrupted between two partitions is simply repeated.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import rank_rows
from ..session import shared_dir
from .tables import one_per_key

PART = "_part"


@dataclass(frozen=True)
class KeyedTable:
    path: str
    key: tuple[str, ...]
    partitions: int
    schema: T.StructType
    id_col: str | None = None

    @property
    def rows_path(self) -> str:
        return f"{self.path}/rows"

    def part(self, columns: Sequence[str] | None = None) -> Column:
        return key_part(columns or self.key, self.partitions)


def key_part(columns: Sequence[str], partitions: int) -> Column:
    """Partition of a key: NULLs are a value like others."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(partitions)).cast("int")


def create_keyed(df: DataFrame, path: str, key: str | Sequence[str], partitions: int,
                 id_col: str | None = None) -> KeyedTable:
    """Write ``df`` as a new keyed table.  ``partitions``: about the table's
    expected size over 256 MB.  With ``id_col`` (a column of ``df``) later
    merges number the rows they insert after its largest value.  Keys that
    occur twice fail the write."""
    spark, path = df.sparkSession, path.rstrip("/")
    keys = (key,) if isinstance(key, str) else tuple(key)
    table = KeyedTable(path, keys, partitions, df.schema, id_col)
    shared_dir(spark)
    rows = one_per_key(df, keys).checkpoint(eager=True)
    _overwrite(table, rows)
    if id_col:
        rows.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("last")).write.mode("overwrite").parquet(f"{path}/last_id")
    layout = spark.createDataFrame([(list(keys), partitions, df.schema.json(), id_col)],
                                   "key array<string>, partitions int, schema string, id_col string")
    layout.write.parquet(f"{path}/layout")
    return table


def open_keyed(spark: SparkSession, path: str) -> KeyedTable:
    path = path.rstrip("/")
    row = spark.read.parquet(f"{path}/layout").first()
    return KeyedTable(path, tuple(row["key"]), row["partitions"], T.StructType.fromJson(json.loads(row["schema"])), row["id_col"])


def open_or_create(spark: SparkSession, path: str, schema: T.StructType, key: str | Sequence[str], partitions: int,
                   id_col: str | None = None) -> KeyedTable:
    """The keyed table at ``path``; an empty one of these settings if there is
    none.  The layout is written last, so a table half made is made again."""
    try:
        return open_keyed(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    return create_keyed(spark.createDataFrame([], schema), path, key, partitions, id_col)


def _stored(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return spark.read.schema(T.StructType([*table.schema.fields, T.StructField(PART, T.IntegerType())])).parquet(table.rows_path)


def read_keyed(spark: SparkSession, table: KeyedTable) -> DataFrame:
    return _stored(spark, table).drop(PART)


def partitions_read(spark: SparkSession, table: KeyedTable, parts: Sequence[int]) -> DataFrame:
    """The rows of some partitions: the scan lists only their folders."""
    return _stored(spark, table).filter(F.col(PART).isin(list(parts)))


def _overwrite(table: KeyedTable, rows: DataFrame) -> None:
    """Replace the partitions that ``rows`` falls into; AQE cuts a partition
    into files of its advisory size and packs small ones into one task."""
    placed = rows.withColumn(PART, table.part()).hint("rebalance", PART)
    (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(table.rows_path))


def merge_keyed(spark: SparkSession, table: KeyedTable, new: DataFrame, touched_col: str | None = None, now=None,
                order_col: str | None = None) -> list[int]:
    """Insert or update by key, in place; returns the partitions rewritten.

    The rules are those of :func:`tables.upsert_by_key`: a known key takes the
    columns of ``new`` (NULLs too) and keeps its id and its other columns;
    ``touched_col`` becomes ``now``; a new key is inserted and numbered after
    the largest id ever given out, in key order.  Several rows of one key: the
    largest ``order_col``, or an error without one.

    Driver state: the numbers of the partitions touched.  The merged
    partitions are materialised before any is overwritten.
    """
    keys = list(table.key)
    shared_dir(spark)
    new = one_per_key(new, keys, order_col)
    given = [c for c in new.columns if c in table.schema.names and c != table.id_col]
    new = new.select(*given).withColumn(PART, table.part()).checkpoint(eager=True)
    parts = sorted(r[0] for r in new.select(PART).distinct().collect())  # at most table.partitions
    if not parts:
        return []
    old = partitions_read(spark, table, parts).withColumn("_old", F.lit(True))
    theirs = new.select(*[F.col(c).alias(f"_n_{c}") for c in given], F.col(PART).alias("_n_part"), F.lit(True).alias("_new"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys], F.col(PART) == F.col("_n_part"))
    stamp = (F.current_timestamp() if now is None else F.lit(now)).cast(table.schema[touched_col].dataType) if touched_col else None
    values = []
    for c in table.schema.names:
        newer = stamp if c == touched_col else F.col(f"_n_{c}") if c in given else F.col(c)
        values.append(F.when(F.col("_new"), newer).otherwise(F.col(c)).alias(c))
    merged = old.join(theirs, same, "full_outer").select(*values, F.col("_old").isNull().alias("_fresh")).checkpoint(eager=True)
    rows = merged.filter(~F.col("_fresh")).drop("_fresh")
    fresh = merged.filter(F.col("_fresh")).drop("_fresh")
    if table.id_col:
        last = spark.read.schema("last long").parquet(f"{table.path}/last_id").agg(F.coalesce(F.max("last"), F.lit(0))).first()[0]
        id_type = table.schema[table.id_col].dataType
        numbered = rank_rows(fresh, keys, out="_seq", method="row_number").withColumn(
            table.id_col, (F.col("_seq") + F.lit(last)).cast(id_type)).select(*table.schema.names).checkpoint(eager=True)
        # Ids count as given out before a row holds them, so none is given twice.
        inserted = numbered.count()
        if inserted:
            spark.createDataFrame([(last + inserted,)], "last long").write.mode("append").parquet(f"{table.path}/last_id")
        fresh = numbered
    _overwrite(table, rows.unionByName(fresh))
    return parts
