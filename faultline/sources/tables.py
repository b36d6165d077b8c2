"""Reading, writing, appending and upserting tables.

Tables are parquet (or CSV) folders.  Writes never replace the folder being
read: an upsert writes the merged table to a new folder and returns its
path, so a failed job leaves the previous version intact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..operators.joins import checked_broadcast, join_null_safe
from ..operators.ranking import rank_rows
from ..session import shared_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read table ``name`` stored as ``{base}/{name}.parquet``; ``base`` is any
    path or URI Spark can read."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def tables(spark: SparkSession, base: str, names: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """Read several tables of one folder, by name."""
    return {n: table(spark, base, n) for n in names}


# CSV options for text fields holding commas, quotes and line breaks.
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# A field may hold line breaks, so a CSV file cannot be split: one task reads
# it whole.  Files are kept to this many records to keep tasks small.
CSV_RECORDS_PER_FILE = 100_000

# The reader turns a quoted empty field into this marker (an unquoted empty
# field is NULL); string columns then map it back to ''.  Without it both
# read back as NULL.
_EMPTY_MARK = "\u0000empty\u0000"


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header row; NULL and '' stay distinct, and a field that does
    not fit its type fails the read (no silent NULL).  Pass ``schema`` in
    production: inference scans the data twice and guesses types.  Each file
    is read by one task, see ``CSV_RECORDS_PER_FILE``."""
    reader = spark.read.options(**CSV_OPTIONS).option("emptyValue", _EMPTY_MARK).option("mode", "FAILFAST")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    df = reader.csv(path)
    return df.select(*[F.when(F.col(f.name) == _EMPTY_MARK, F.lit("")).otherwise(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, StringType) else F.col(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists",
              records_per_file: int = CSV_RECORDS_PER_FILE) -> str:
    """Write CSV with a header, quoting that keeps commas, quotes and line breaks."""
    (df.write.mode(mode).options(**CSV_OPTIONS).option("maxRecordsPerFile", records_per_file).csv(path))
    return path


def empty_table(spark: SparkSession, schema: StructType | str, path: str,
                fmt: str = "parquet") -> DataFrame:
    """Create (replace) an empty typed table and return it read back."""
    spark.createDataFrame([], schema).write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).schema(schema).load(path) if fmt != "parquet" else spark.read.parquet(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Append rows to a table folder (``INSERT ... VALUES`` in bulk)."""
    df.write.mode("append").format(fmt).save(path)


def next_ids(existing: DataFrame, new: DataFrame, id_col: str, order: Sequence) -> DataFrame:
    """Give ``new`` rows ids after the largest existing one (AUTO_INCREMENT).

    Ids are ``max(existing) + row_number`` in ``order``; the numbering is the
    range-partitioned :func:`rank_rows`, the maximum a scalar subquery.
    """
    top = existing.select(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    numbered = rank_rows(new, order, out="_seq", method="row_number")
    return numbered.select((top + F.col("_seq")).alias(id_col), *new.columns)


def append_with_ids(spark: SparkSession, path: str, new: DataFrame, id_col: str,
                    order: Sequence, fmt: str = "parquet") -> DataFrame:
    """Append ``new`` to the table at ``path`` with generated ids; returns the rows written."""
    existing = spark.read.format(fmt).load(path)
    rows = next_ids(existing, new, id_col, order).select(*existing.columns)
    append_rows(rows, path, fmt)
    return rows


def one_per_key(new: DataFrame, keys: Sequence[str], order_col: str | None = None) -> DataFrame:
    """A row per key (NULL keys are one): that of the largest ``order_col``;
    without one a key that occurs twice fails the job."""
    rec = F.struct(*[F.col(c) for c in new.columns])
    if order_col:
        return new.groupBy(*keys).agg(F.max_by(rec, F.col(order_col)).alias("_r")).select("_r.*")
    return (new.groupBy(*keys).agg(F.any_value(rec).alias("_r"), F.count(F.lit(1)).alias("_c"))
            .select(F.when(F.col("_c") > 1, F.raise_error(F.lit("duplicate key in upsert input"))).otherwise(F.col("_r")).alias("_r"))
            .select("_r.*"))


def upsert_by_key(old: DataFrame, new: DataFrame, key: str | Sequence[str],
                  id_col: str | None = None, touched_col: str | None = None, now=None,
                  prune: bool = False, order_col: str | None = None,
                  change_col: str | None = None) -> DataFrame:
    """``INSERT ... ON DUPLICATE KEY UPDATE`` as a DataFrame merge.

    * key in both: every column of ``new`` replaces the old value (a NULL
      too), ``id_col`` keeps the old id, ``touched_col`` becomes ``now``;
    * key only in ``new``: inserted; its id is ``max(old id) + row_number``
      in key order;
    * key only in ``old``: kept unchanged (``prune=True`` drops it).

    NULL keys are one key, as in GROUP BY.  Several ``new`` rows with one key:
    the one with the largest ``order_col`` wins (the reference's last write);
    without ``order_col`` such input is rejected when the merge runs.

    ``new`` is reduced to a row per key and materialised.  The old rows are
    read once for the result, without a shuffle when the new rows are proven
    small; two narrow scans find which new keys are known and the largest id.
    Only inserted rows are numbered.  The result is the whole table; for few
    rows into a large one see :mod:`keyed`.
    """
    keys = [key] if isinstance(key, str) else list(key)
    shared_dir(old.sparkSession)
    new = one_per_key(new, keys, order_col).checkpoint(eager=True)
    stamp = (F.current_timestamp() if now is None else F.lit(now)).cast(
        old.schema[touched_col].dataType) if touched_col else None

    small = checked_broadcast(new)
    theirs = small.select(*[F.col(c).alias(f"_n_{c}") for c in new.columns], F.lit(True).alias("_hit"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys])
    values = []
    for c in old.columns:
        newer = stamp if c == touched_col else F.col(f"_n_{c}") if c in new.columns and c != id_col else F.col(c)
        values.append(F.when(F.col("_hit"), newer).otherwise(F.col(c)).alias(c))
    if change_col:
        values.append(F.when(F.col("_hit"), F.lit("update")).otherwise(F.lit("keep")).alias(change_col))
    parts = [old.join(theirs, on=same, how="inner" if prune else "left").select(*values)]
    known = old.select(*[F.col(k).alias(f"_n_{k}") for k in keys])
    known = join_null_safe(known.select(*[F.col(f"_n_{k}").alias(k) for k in keys]), small.select(*keys), keys,
                           how="left_semi").distinct()  # the new keys that are in the old table
    fresh = join_null_safe(new, known, keys, how="left_anti")
    fresh = fresh.select(*[stamp.alias(c) if c == touched_col else
                           (F.col(c) if c in new.columns and c != id_col else F.lit(None).cast(old.schema[c].dataType).alias(c))
                           for c in old.columns])
    if id_col:
        fresh = next_ids(old, fresh.drop(id_col), id_col, keys).select(*old.columns)
    parts.append(fresh.withColumn(change_col, F.lit("insert")) if change_col else fresh)
    return reduce(DataFrame.unionByName, parts)


def write_upsert(spark: SparkSession, old_path: str, new: DataFrame, key: str | Sequence[str],
                 out_path: str, fmt: str = "parquet", **kwargs) -> DataFrame:
    """Merge ``new`` into the table at ``old_path``, writing the result to
    ``out_path`` (never over the input); returns the new version read back."""
    if old_path.rstrip("/") == out_path.rstrip("/"):
        raise ValueError("write the merged table to a new path, not over its input")
    old = spark.read.format(fmt).load(old_path)
    upsert_by_key(old, new, key, **kwargs).write.mode("errorifexists").format(fmt).save(out_path)
    return spark.read.format(fmt).load(out_path)
