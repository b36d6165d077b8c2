"""Global ranking and numbering without a single-partition window.

``Window.orderBy(...)`` with no partition moves every row to one task.  Here
rows are range-partitioned on the sort key, sorted within partitions and
numbered by position; each partition's offset is the running total of the
partitions before it - one number per partition, a bound set by the partition
count and not by the data.  The range-sorted rows are checkpointed once into
the session's shared folder, so counts and positions come from one
materialisation, also when a task or an executor is retried.

``rank`` needs only how many rows each sort key has.  The input is reduced
to its distinct keys with their counts (partial/final aggregate: a key - or a
group of identical rows - holding a third of the input is one row per task),
the unique keys are ranked by a weighted running sum inside each range
partition plus the partition's offset, and the ranks are joined back on the
key (broadcast when the keys are proven small, else a shuffle join AQE can
split).  The input itself is checkpointed first, so its lineage is evaluated
once.

``row_number`` numbers the rows: the range key is the sort key, a hash of the
row, the row's values, and - between identical rows - where the checkpoint
holds them, so large tie groups and piles of identical rows spread over
partitions and the numbers do not depend on the input's layout.

There is one path for every size.  Rows in *read* order: :func:`sequence_ids`,
which moves no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..session import shared_dir
from .joins import DEFAULT_BROADCAST_MAX_ROWS, fits

_SALT, _MID, _PID, _POS, _N, _OFF, _ROW = ("_rk_salt", "_rk_mid", "_rk_pid", "_rk_pos", "_rk_n",
                                           "_rk_off", "_rk_row")
_FILE, _BLOCK = "_rk_file", "_rk_block"
_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _order(order: Sequence) -> list[tuple[str, bool]]:
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o, True))
        else:
            name, asc = o
            out.append((name, asc if isinstance(asc, bool) else str(asc).lower() == "asc"))
    return out


def sort_columns(order: Sequence) -> list[Column]:
    """SQL default null placement: ASC NULLS FIRST, DESC NULLS LAST."""
    return [F.col(n).asc_nulls_first() if a else F.col(n).desc_nulls_last() for n, a in _order(order)]


def _offsets(ranged: DataFrame, weight: Column) -> DataFrame:
    """Running total of the partitions before each: a row per partition."""
    sizes = ranged.groupBy(_PID).agg(weight.alias(_OFF))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(_PID, F.coalesce(F.sum(_OFF).over(before), F.lit(0)).alias(_OFF))


def _range_materialised(df: DataFrame, sort: list[Column], partitions: int | None) -> DataFrame:
    """Range-partition, sort within partitions, number by position, checkpoint.

    Without an explicit count the range shuffle uses the session's partition
    count and AQE may merge neighbouring small ranges - still in order."""
    ranged = df.repartitionByRange(partitions, *sort) if partitions else df.repartitionByRange(*sort)
    ranged = (ranged.sortWithinPartitions(*sort)
                    .withColumn(_MID, F.monotonically_increasing_id())
                    .checkpoint(eager=True))
    return ranged.withColumn(_PID, F.shiftright(F.col(_MID), _POS_BITS)).withColumn(
        _POS, F.col(_MID).bitwiseAND(F.lit((1 << _POS_BITS) - 1)))


def rank_rows(df: DataFrame, order: Sequence, out: str = "rank", method: str = "rank",
              partitions: int | None = None,
              broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Add a global ``rank`` or ``row_number`` column (BIGINT) ordered by ``order``.

    ``order``: column names (ascending) or ``(name, ascending)`` pairs.  Rows
    tied on ``order`` are numbered by a hash of the row and then by their
    values: the same numbers whatever the input's order and partitioning.
    """
    if method not in ("rank", "row_number"):
        raise ValueError(f"unknown method {method!r}")
    shared_dir(df.sparkSession)
    names = [n for n, _ in _order(order)]
    cols = df.columns
    base = df.checkpoint(eager=True)
    if method == "rank":
        return _rank_by_key_counts(base, order, names, out, partitions, broadcast_max_rows)

    hashable = [f.name for f in base.schema.fields if not isinstance(f.dataType, MapType)]
    salt = F.xxhash64(*[F.col(c) for c in hashable]) if hashable else F.lit(0).cast("long")
    placed = base.withColumn(_SALT, salt).withColumn(_ROW, F.monotonically_increasing_id())
    ties = [F.col(c) for c in hashable if c not in names]
    sort = [*sort_columns(order), F.col(_SALT), *ties, F.col(_ROW)]
    ranged = _range_materialised(placed, sort, partitions)
    offsets = _offsets(ranged, F.count(F.lit(1)))  # a row per partition
    return ranged.join(F.broadcast(offsets), on=_PID, how="inner").select(
        *cols, (F.col(_OFF) + F.col(_POS) + F.lit(1)).cast("long").alias(out))


def _rank_by_key_counts(df: DataFrame, order: Sequence, names: list[str], out: str,
                        partitions: int | None, broadcast_max_rows: int | None) -> DataFrame:
    """``rank`` of a materialised input through its distinct keys (see rank_rows)."""
    keys = df.groupBy(*names).agg(F.count(F.lit(1)).alias(_N))          # unique keys, no ties left
    ranged = _range_materialised(keys, sort_columns(order), partitions)
    # Rows of one range partition meet in one task (their partition's size),
    # where a running sum gives the rows with a smaller key inside it.
    before = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumn(_ROW, F.coalesce(F.sum(_N).over(before), F.lit(0)))
    ranks = inside.join(F.broadcast(_offsets(ranged, F.sum(_N))), on=_PID, how="inner").select(
        *[F.col(c) for c in names], (F.col(_OFF) + F.col(_ROW) + F.lit(1)).cast("long").alias(out))
    keyed = [f"_rk_k{i}" for i in range(len(names))]
    # One row per distinct key: broadcast when those are proven small.
    small = fits(ranged.select(*names), broadcast_max_rows)
    ranks = ranks.select(*[F.col(c).alias(k) for c, k in zip(names, keyed)], out)
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(names, keyed)])
    return (df.join(F.broadcast(ranks) if small else ranks, on=cond, how="inner")
              .select(*df.columns, out))


def sequence_ids(df: DataFrame, out: str = "id", order: Sequence | None = None) -> DataFrame:
    """Number rows 1..n in ingest order.

    ``order`` names the ingest column(s).  Without it the rows of a file scan
    (and row-wise operations on it) are numbered by file name, then by their
    position in the file: Spark packs files into tasks by size, so the read
    order itself is no order.  A DataFrame that no file stands behind is
    numbered in the order of its partitions.

    Rows of a scan are not moved: one narrow pass counts them per block of a
    file, the counts are summed up in file order, and an id is the sum before
    the block plus the row's place in it.  A block read elsewhere the second
    time (another packing of the files) fails the job rather than misnumber.
    """
    cols = df.columns
    if order is not None:
        return rank_rows(df, order, out=out, method="row_number").select(out, *cols)
    position = F.monotonically_increasing_id().alias(_MID)  # ascending inside a block of a file
    try:
        scan = df.select(*cols, F.col("_metadata.file_path").alias(_FILE),
                         F.col("_metadata.file_block_start").alias(_BLOCK), position)
    except AnalysisException:  # no file behind it
        seq = df.select(*cols, F.lit("").alias(_FILE), F.lit(0).cast("long").alias(_BLOCK), position)
        return rank_rows(seq, [_FILE, _BLOCK, _MID], out=out, method="row_number").select(out, *cols)
    shared_dir(df.sparkSession)
    # A row per block (tens of MB of a file each): the bound of the window and of the broadcast.
    blocks = scan.groupBy(_FILE, _BLOCK).agg(F.count(F.lit(1)).alias(_N), F.min(_MID).alias(_POS)).checkpoint(eager=True)
    before = Window.orderBy(_FILE, _BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(F.col(_FILE).alias("_rk_f"), F.col(_BLOCK).alias("_rk_b"), F.col(_POS), F.col(_N),
                            F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_OFF))
    place = F.col(_MID) - F.col(_POS)
    moved = F.col(_POS).isNull() | (place < 0) | (place >= F.col(_N))
    number = F.when(moved, F.raise_error(F.lit("a file was read in other tasks the second time")).cast("long")).otherwise(
        F.col(_OFF) + place + F.lit(1))
    same = (F.col(_FILE) == F.col("_rk_f")) & (F.col(_BLOCK) == F.col("_rk_b"))
    return scan.join(F.broadcast(offsets), same, "left").select(number.cast("long").alias(out), *cols)
