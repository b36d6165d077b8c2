"""Table constraints restated as data-quality jobs, and column profiles.

Spark's file tables enforce no PRIMARY KEY, UNIQUE, FOREIGN KEY or CHECK,
so each constraint becomes a query returning its violations (empty result =
constraint holds).  Key checks are partial/final aggregations or semi/anti
joins; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .joins import checked_broadcast

PROFILE_PREFIX = 16  # characters
KEY_SEED = 0x9E3779B9  # sets a key's second hash apart from the first


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None,
                name: str = "column", out: str = "nulls") -> DataFrame:
    """NULLs per column (``df.isnull().sum()``), one row per column.

    One scan with one conditional count per column; the single result row is
    unpivoted.
    """
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, name, out)


def null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows breaking ``NOT NULL`` on any of ``cols``."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def unique_violations(df: DataFrame, keys: str | Sequence[str], out: str = "count") -> DataFrame:
    """Key values occurring more than once (PRIMARY KEY / UNIQUE), with their count."""
    keys = _list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
              .filter(F.col(out) > 1))


def fk_violations(child: DataFrame, parent: DataFrame, child_key: str | Sequence[str],
                  parent_key: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows whose non-null key has no parent (orphans), via a left anti join.

    A NULL foreign key is not a violation (SQL semantics).
    """
    ck, pk = _list(child_key), _list(parent_key or child_key)
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(pk, ck)])
    nonnull = child
    for c in ck:
        nonnull = nonnull.filter(F.col(c).isNotNull())
    return nonnull.join(parents, on=ck, how="left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str | Sequence[str],
                parent_key: str | Sequence[str] | None = None, out: str = "rows") -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows
    holding each.

    The child is first reduced to one row per key (partial/final count; a
    hot key is one row per task), so the anti join shuffles distinct keys,
    not child rows.  NULL keys are not violations.
    """
    ck, pk = _list(child_key), _list(parent_key or child_key)
    keys = child
    for c in ck:
        keys = keys.filter(F.col(c).isNotNull())
    keys = keys.groupBy(*ck).agg(F.count(F.lit(1)).alias(out))
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(pk, ck)])
    return keys.join(parents, on=ck, how="left_anti")


def range_violations(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows failing ``CHECK (col BETWEEN lo AND hi)``; NULL passes a CHECK."""
    return df.filter(F.col(col).isNotNull() & ~F.col(col).between(lo, hi))


def length_violations(df: DataFrame, col: str, max_len: int, out: str = "length") -> DataFrame:
    """Rows whose ``col`` is longer than ``max_len`` characters (``VARCHAR(n)``)."""
    return (df.withColumn(out, F.length(col).cast("long"))
              .filter(F.col(out) > F.lit(max_len)))


def restrict_delete_blocked(parent: DataFrame, child: DataFrame, parent_key: str | Sequence[str],
                            child_key: str | Sequence[str] | None = None) -> DataFrame:
    """Parent rows that ``ON DELETE RESTRICT`` protects: they have children.

    The child is first reduced to its distinct keys (a hot key is one row per
    task)."""
    pk, ck = _list(parent_key), _list(child_key or parent_key)
    refs = child.select(*[F.col(c).alias(p) for c, p in zip(ck, pk)]).distinct()
    return parent.join(refs, on=pk, how="left_semi")


def cascade_delete(child: DataFrame, deleted: DataFrame, child_key: str | Sequence[str],
                   parent_key: str | Sequence[str] | None = None) -> DataFrame:
    """Child rows left after deleting parents ``deleted`` with ``ON DELETE CASCADE``."""
    ck, pk = _list(child_key), _list(parent_key or child_key)
    gone = deleted.select(*[F.col(p).alias(c) for p, c in zip(pk, ck)])
    return child.join(gone, on=ck, how="left_anti")


def cascade_rekey(child: DataFrame, mapping: DataFrame, child_key: str,
                  old: str = "old_key", new: str = "new_key") -> DataFrame:
    """Apply ``ON UPDATE CASCADE``: children take the parent's new key.

    ``mapping`` holds (old, new) pairs, one per old key (more are rejected when
    the job runs); unmapped children keep their key.
    Left join on the old key, so no child row is lost.
    """
    # A row per old key; a key mapped twice would multiply its children.
    m = (mapping.groupBy(F.col(old).alias(child_key)).agg(F.any_value(new).alias("_n"), F.count(F.lit(1)).alias("_c"))
         .select(child_key, F.when(F.col("_c") > 1, F.raise_error(F.lit("old key mapped more than once")))
                 .otherwise(F.col("_n")).alias("_new_key")))
    cols = [F.coalesce(F.col("_new_key"), F.col(child_key)).alias(child_key) if c == child_key
            else F.col(c) for c in child.columns]
    return child.join(m, on=child_key, how="left").select(*cols)


def functional_dependency(df: DataFrame, determinant: str | Sequence[str], dependent: str,
                          out: str = "distinct_count") -> DataFrame:
    """Determinant values mapping to more than one ``dependent`` value (3NF check)."""
    det = _list(determinant)
    return (df.groupBy(*det).agg(F.count_distinct(dependent).alias(out))
              .filter(F.col(out) > 1))


def profile_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``describe(include="all")`` for text: count, unique, top, freq per column.

    Values are compared as strings, told apart by a 128-bit hash: the columns
    are unpivoted to (column, hash) and counted per hash, so no long value is
    shuffled.  ``top`` is the smallest value of the largest count; a hash keeps
    the first characters of its value, which narrow a column's candidates down
    to few hashes, and those values alone are fetched.  NULLs count in nothing;
    a column of NULLs alone has count and unique 0 and no top.
    """
    cols = list(cols or df.columns)
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    hashed = texts.withColumn("_h", F.unhex(F.md5("value")))
    shared_dir(df.sparkSession)
    per_value = (hashed.groupBy("column", "_h").agg(F.count("_h").alias("_n"), F.min(F.left("value", F.lit(PROFILE_PREFIX))).alias("_p"))
                 .checkpoint(eager=True))  # read twice
    best = F.min(F.when(F.col("_h").isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col("_p").alias("p"))))
    stats = (per_value.groupBy("column").agg(F.sum("_n").cast("long").alias("count"), F.count("_h").alias("unique"), best.alias("_b"))
             .select("column", "count", "unique", (-F.col("_b.n")).alias("freq"), F.col("_b.p").alias("_p")).checkpoint(eager=True))
    tied = per_value.join(F.broadcast(stats.select("column", F.col("freq").alias("_n"), "_p")),  # a row per column
                          ["column", "_n", "_p"]).select("column", "_h")
    tops = (hashed.join(checked_broadcast(tied), ["column", "_h"], "left_semi")
            .groupBy("column").agg(F.min("value").alias("top")))
    return stats.join(tops, "column", "left").select("column", "count", "unique", "top", "freq").orderBy("column")


def profile_shape(df: DataFrame) -> DataFrame:
    """``df.shape`` as one row (rows, columns)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def head_rows(df: DataFrame, order: str | Sequence[str], n: int = 5) -> DataFrame:
    """``df.head(n)`` made deterministic: the first ``n`` rows by ``order``
    (a per-partition top-n merged once)."""
    return df.orderBy(*_list(order)).limit(n)


def schema_info(df: DataFrame) -> DataFrame:
    """``df.info()``: column, type and non-null count, one row per column."""
    cols = df.columns
    wide = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    mapping = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return (wide.unpivot([], cols, "column", "non_null")
                .withColumn("type", mapping[F.col("column")])
                .select("column", "type", "non_null"))


@dataclass(frozen=True)
class Constraint:
    """A declared table constraint.

    ``kind``: ``not_null``, ``primary_key``, ``unique``, ``foreign_key``
    (``arg`` = (parent table, parent columns)), ``between`` (``arg`` = (lo,
    hi)) or ``max_length`` (``arg`` = n).
    """

    table: str
    kind: str
    columns: tuple[str, ...]
    arg: object = None


def violations(tables: Mapping[str, DataFrame], c: Constraint) -> DataFrame:
    """The rows (or key groups) breaking one constraint."""
    df = tables[c.table]
    cols = list(c.columns)
    if c.kind == "not_null":
        return null_violations(df, cols)
    if c.kind in ("primary_key", "unique"):
        nonnull = df
        if c.kind == "unique":  # NULLs never collide in a UNIQUE key
            for col in cols:
                nonnull = nonnull.filter(F.col(col).isNotNull())
        return unique_violations(nonnull, cols)
    if c.kind == "foreign_key":
        parent, pcols = c.arg
        return fk_violations(df, tables[parent], cols, list(pcols))
    if c.kind == "between":
        lo, hi = c.arg
        return range_violations(df, cols[0], lo, hi)
    if c.kind == "max_length":
        return length_violations(df, cols[0], int(c.arg))
    raise ValueError(f"unknown constraint kind {c.kind!r}")


ROW_LEVEL = ("not_null", "between", "max_length")


def row_violation(c: Constraint):
    """Predicate true on a row breaking a row-level constraint."""
    cols = list(c.columns)
    if c.kind == "not_null":
        return reduce(lambda a, b: a | b, [F.col(x).isNull() for x in cols])
    if c.kind == "between":
        lo, hi = c.arg
        return F.col(cols[0]).isNotNull() & ~F.col(cols[0]).between(lo, hi)
    return F.length(cols[0]) > F.lit(int(c.arg))


def constraint_report(tables: Mapping[str, DataFrame], constraints: Sequence[Constraint]) -> DataFrame:
    """One row per constraint: table, kind, columns, violation count.

    Every table is scanned once: a row gives an entry (constraint, 128-bit
    hash of the key) for each key it has or refers to, and one without a key
    for each check it breaks.  One partial/final aggregate counts the child and parent entries
    of every key (a hot key is one row per task), a second one the violations
    of every constraint: rows breaking a check, keys that repeat, child rows
    whose key has no parent.  A constraint on a table that is not given is an
    error: it would pass unchecked.
    """
    constraints = list(constraints)
    if not constraints:
        raise ValueError("no constraint given")
    needed = {c.table for c in constraints} | {c.arg[0] for c in constraints if c.kind == "foreign_key"}
    if missing := sorted(needed - set(tables)):
        raise ValueError("constraints on tables that are not given: " + ", ".join(missing))

    def key(cols, others: Sequence | None = None, nulls: bool = False) -> Column:
        """128 bits of a key: of its typed values, or of their text where the
        other side's columns (types) differ."""
        values = [F.col(x) if others is None or t == o else F.col(x).cast("string")
                  for x, t, o in zip(cols, cols.values(), others or cols.values())]
        marks = [F.col(x).isNull() for x in cols] if nulls else []  # a hash passes over NULLs
        return F.struct(F.xxhash64(*values, *marks).alias("h"), F.xxhash64(F.lit(KEY_SEED), *values, *marks).alias("g"))

    def typed(table: str, cols) -> dict:
        return {c: tables[table].schema[c].dataType for c in cols}

    def entry(i: int, when: Column, value: Column, child: int, parent: int) -> Column:
        return F.when(when, F.struct(F.lit(i).alias("id"), value.alias("key"), F.lit(child).alias("child"),
                                     F.lit(parent).alias("parent")))

    entries: dict[str, list[Column]] = {}
    no_key = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("g"))
    for i, c in enumerate(constraints):
        filled = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in c.columns])
        mine = entries.setdefault(c.table, [])
        if c.kind in ROW_LEVEL:
            mine.append(entry(i, F.coalesce(row_violation(c), F.lit(False)), no_key, 1, 0))
        elif c.kind == "foreign_key":
            parent, pcols = c.arg
            ours, theirs = typed(c.table, c.columns), typed(parent, pcols)
            mine.append(entry(i, filled, key(ours, list(theirs.values())), 1, 0))
            there = reduce(lambda a, b: a & b, [F.col(x).isNotNull() for x in pcols])
            entries.setdefault(parent, []).append(entry(i, there, key(theirs, list(ours.values())), 0, 1))
        elif c.kind == "unique":  # NULLs never collide in a UNIQUE key
            mine.append(entry(i, filled, key(typed(c.table, c.columns)), 1, 0))
        else:
            mine.append(entry(i, F.lit(True), key(typed(c.table, c.columns), nulls=True), 1, 0))
    rows = reduce(DataFrame.unionAll, [
        tables[t].select(F.explode(F.array_compact(F.array(*es))).alias("e"))
        .select("e.id", "e.key.h", "e.key.g", "e.child", "e.parent") for t, es in entries.items()])
    per_key = rows.groupBy("id", "h", "g").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    kind = F.element_at(F.array(*[F.lit(c.kind) for c in constraints]), F.col("id") + 1)
    broken = (F.when(kind.isin(*ROW_LEVEL), F.col("child"))
              .when(kind == "foreign_key", F.when(F.col("parent") == 0, F.col("child")).otherwise(0))
              .otherwise((F.col("child") > 1).cast("long")))
    counts = per_key.groupBy("id").agg(F.sum(broken).alias("violations"))
    listed = tables[constraints[0].table].sparkSession.createDataFrame(
        [(i, c.table, c.kind, ",".join(c.columns)) for i, c in enumerate(constraints)],
        "id int, table_name string, kind string, columns string")
    return (listed.join(counts, "id", "left")
            .select("table_name", "kind", "columns", F.coalesce("violations", F.lit(0)).cast("long").alias("violations")))


def enforce(tables: Mapping[str, DataFrame], constraints: Sequence[Constraint]) -> None:
    """Raise ``ValueError`` when any constraint is violated (what a database
    does on insert); call it before appending or publishing rows.

    Runs :func:`constraint_report` once; one row per constraint reaches the
    driver.
    """
    broken = [r for r in constraint_report(tables, constraints).collect() if r["violations"]]
    if broken:
        lines = [f"{r['table_name']}.{r['kind']}({r['columns']}): {r['violations']}" for r in broken]
        raise ValueError("constraint violations: " + "; ".join(lines))
