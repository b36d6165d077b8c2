"""Preparation of flat annotated records into a star schema.

filter categories -> check nulls -> classify by keyword ladder -> build
dimensions with surrogate ids -> encode the fact with those ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from ..session import shared_dir
from .joins import DEFAULT_BROADCAST_MAX_ROWS, fits_each
from .quality import null_counts
from .ranking import rank_rows

# The concept ladder of the reference data preparation, in
# priority order (first match wins).  (keyword, concept, minimum occurrences)
CONCEPT_RULES = (
    ("GROUP BY", "GROUP BY", 1),
    ("HAVING", "HAVING", 1),
    ("JOIN", "JOIN", 1),
    ("ORDER BY", "ORDER BY", 1),
    ("WHERE", "WHERE", 1),
    ("DISTINCT", "DISTINCT", 1),
    ("SELECT", "SUBQUERY", 2),
    ("INSERT", "INSERT", 1),
    ("UPDATE", "UPDATE", 1),
    ("DELETE", "DELETE", 1),
)
CONCEPT_DEFAULT = "SELECT"


def filter_categories(df: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    """Keep rows whose ``col`` is one of ``keep`` (pushed to the scan as an IN filter)."""
    return df.filter(F.col(col).isin(list(keep)))


def occurrences(text: Column, keyword: str) -> Column:
    """Non-overlapping occurrences of ``keyword`` in ``text`` (``str.count``)."""
    removed = F.replace(text, F.lit(keyword), F.lit(""))
    return F.call_function("div", F.length(text) - F.length(removed), F.lit(len(keyword)))


def keyword_label(text: Column, rules: Sequence[tuple], default: str | None,
                  upper: bool = True) -> Column:
    """Label from the first matching rule ``(keyword, label[, min_count])``.

    Substring match (a keyword inside a longer word matches, as in the
    reference ladder); ``upper`` upper-cases the text first, so keywords are
    given in upper case.  NULL text gives NULL.
    """
    t = F.upper(text) if upper else text
    expr = None
    for rule in rules:
        kw, label = rule[0], rule[1]
        need = rule[2] if len(rule) > 2 else 1
        cond = F.contains(t, F.lit(kw)) if need <= 1 else occurrences(t, kw) >= F.lit(need)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return F.when(text.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(F.lit(default)))


def classify_by_keywords(df: DataFrame, text_col: str, rules: Sequence[tuple] = CONCEPT_RULES,
                         default: str | None = CONCEPT_DEFAULT, out: str = "concept",
                         upper: bool = True) -> DataFrame:
    """Add ``out`` = label of the first rule whose keyword occurs in ``text_col``.

    The upper-cased text is a column of its own, so it is computed once per
    row rather than once per rule.
    """
    if not upper:
        return df.withColumn(out, keyword_label(F.col(text_col), rules, default, False))
    folded = df.withColumn("_upper_text", F.upper(F.col(text_col)))
    return (folded.withColumn(out, keyword_label(F.col("_upper_text"), rules, default, upper=False))
                  .drop("_upper_text"))


def build_dimension(df: DataFrame, col: str, id_name: str = "id", name: str | None = None,
                    mode: str = "sorted", order_col: str | None = None) -> DataFrame:
    """Distinct non-null members of ``col`` with surrogate ids 1..n.

    ``mode="sorted"``: ids follow the member order.  ``mode="first_seen"``:
    ids follow each member's first ``order_col`` value (a DataFrame has no
    row order of its own, so ingest order must be a column).  Numbering uses
    the range-partitioned :func:`rank_rows`, never a one-partition window.
    """
    name = name or col
    members = df.where(F.col(col).isNotNull())
    if mode == "sorted":
        base = members.select(F.col(col).alias(name)).distinct()
        order = [name]
    elif mode == "first_seen":
        if not order_col:
            raise ValueError("first_seen numbering needs order_col")
        base = members.groupBy(F.col(col).alias(name)).agg(F.min(order_col).alias("_first"))
        order = ["_first", name]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    numbered = rank_rows(base, order, out=id_name, method="row_number")
    return numbered.select(id_name, name)


def build_dimensions(df: DataFrame, specs: Sequence[tuple[str, str, str]],
                     order_col: str | None = None) -> dict[str, DataFrame]:
    """Several dimensions in one pass over ``df``.

    ``specs``: ``(column, id_name, mode)`` as in :func:`build_dimension`.
    String columns are unpivoted to (dimension, member, order), reduced by
    one partial/final aggregate and numbered by one range-partitioned
    :func:`rank_rows` over (dimension, first order | -, member); each
    dimension's ids start at 1 (its first row number comes from a table with
    one row per dimension).  Other column types are built one by one, as
    their order differs from the string order.
    """
    out: dict[str, DataFrame] = {}
    types = {f.name: f.dataType for f in df.schema.fields}
    combined = [(i, spec) for i, spec in enumerate(specs) if isinstance(types[spec[0]], StringType)]
    for col, id_name, mode in specs:
        if not isinstance(types[col], StringType):
            out[col] = build_dimension(df, col, id_name=id_name, mode=mode, order_col=order_col)
    if not combined:
        return out
    if any(mode == "first_seen" for _, (_, _, mode) in combined) and not order_col:
        raise ValueError("first_seen numbering needs order_col")
    order_type = types[order_col] if order_col else LongType()
    parts = []
    for i, (col, _, mode) in combined:
        if mode not in ("sorted", "first_seen"):
            raise ValueError(f"unknown mode {mode!r}")
        first = F.col(order_col) if mode == "first_seen" else F.lit(None).cast(order_type)
        parts.append(F.struct(F.lit(i).alias("_d"), F.col(col).alias("_member"), first.alias("_first")))
    members = (df.select(F.explode(F.array(*parts)).alias("_e")).select("_e.*")
                 .filter(F.col("_member").isNotNull())
                 .groupBy("_d", "_member").agg(F.min("_first").alias("_first")))
    numbered = rank_rows(members, ["_d", "_first", "_member"], out="_rn", method="row_number")
    # One row per dimension: a bound set by `specs`.
    starts = numbered.groupBy("_d").agg(F.min("_rn").alias("_start"))
    ids = numbered.join(F.broadcast(starts), on="_d").select(
        "_d", "_member", (F.col("_rn") - F.col("_start") + F.lit(1)).alias("_id"))
    for i, (col, id_name, _) in combined:
        out[col] = ids.filter(F.col("_d") == i).select(F.col("_id").alias(id_name), F.col("_member").alias(col))
    return out


def extend_dimension(dimension: DataFrame, new: DataFrame, col: str, id_name: str = "id", name: str | None = None,
                     mode: str = "sorted", order_col: str | None = None) -> DataFrame:
    """The rows to append to a stored ``dimension`` (id, name) so that it holds
    the members of ``new[col]`` too; no member it has changes its id.

    New members (an anti join of the distinct values with the dimension) are
    numbered after the largest id, in member order or, with ``first_seen``, by
    their first ``order_col``.  NULL is no member.
    """
    name = name or col
    if mode == "first_seen" and not order_col:
        raise ValueError("first_seen numbering needs order_col")
    if mode not in ("sorted", "first_seen"):
        raise ValueError(f"unknown mode {mode!r}")
    first = F.min(order_col) if mode == "first_seen" else F.lit(None).cast("long")
    members = new.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(name)).agg(first.alias("_first"))
    unknown = members.join(dimension.select(name), name, "left_anti")
    last = dimension.agg(F.coalesce(F.max(id_name), F.lit(0)).cast("long")).scalar()
    ids = rank_rows(unknown, ["_first", name] if mode == "first_seen" else [name], out="_rn", method="row_number")
    return ids.select((F.col("_rn") + last).cast(dimension.schema[id_name].dataType).alias(id_name), name)


def load_star(flat: DataFrame, order_col: str, dimensions: Sequence[tuple], stored: Mapping[str, DataFrame]) -> Star:
    """A further load of prepared rows: the members that ``stored`` dimensions
    (column -> DataFrame) lack, with ids after theirs, and the fact rows of
    this load encoded with old and new ids.

    ``Star.dimensions`` holds the rows to append, ``Star.fact`` the rows to
    append to the fact; nothing that was stored is read but the dimensions.
    """
    shared_dir(flat.sparkSession)
    added, encodings = {}, []
    for col, id_name, mode in dimensions:
        added[col] = extend_dimension(stored[col], flat, col, id_name, mode=mode, order_col=order_col).checkpoint(eager=True)
        encodings.append((col, stored[col].select(id_name, col).unionByName(added[col]), col, id_name))
    return Star(encode_fact(flat, encodings), added)


def encode_fact(fact: DataFrame, encodings: Sequence[tuple[str, DataFrame, str, str]],
                broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Replace member columns by surrogate ids.

    ``encodings``: ``(fact_col, dimension, dim_name_col, dim_id_col)``; the id
    column takes the place of ``fact_col`` (same position).  Left joins, so a
    row whose member is missing keeps a NULL id instead of disappearing.
    """
    out = fact
    order = list(fact.columns)
    lookups = [dim.select(F.col(name_col).alias(col), F.col(id_col)) for col, dim, name_col, id_col in encodings]
    for (col, _, _, id_col), lookup, small in zip(encodings, lookups, fits_each(lookups, broadcast_max_rows)):
        out = out.join(F.broadcast(lookup) if small else lookup, on=col, how="left").drop(col)
        order = [id_col if c == col else c for c in order]
    return out.select(*order)


@dataclass
class Star:
    """Result of :func:`build_star`: the encoded fact, its dimensions and the
    NULL count of every input column (lazy, one scan when read)."""

    fact: DataFrame
    dimensions: dict[str, DataFrame]
    nulls: DataFrame | None = None


def build_star(flat: DataFrame, order_col: str, dimensions: Sequence[tuple],
               category_col: str | None = None, keep: Sequence[str] | None = None,
               text_col: str | None = None, rules: Sequence[tuple] = CONCEPT_RULES,
               default: str | None = CONCEPT_DEFAULT, label_col: str = "concept") -> Star:
    """Prepare flat records: filter, classify, build dimensions, encode.

    The text is read once, for the label; the encoded fact does not hold it.
    ``dimensions``: ``(column, id_name, mode)`` with mode ``sorted`` or
    ``first_seen``.  The label column from classification may be listed too.
    """
    df = flat
    if category_col and keep is not None:
        df = filter_categories(df, category_col, keep)
    if text_col:
        df = classify_by_keywords(df, text_col, rules, default, out=label_col)
        # Dimensions and fact read the narrow labelled rows, not the texts again.
        shared_dir(df.sparkSession)
        df = df.drop(text_col).checkpoint(eager=True)
    dims = build_dimensions(df, dimensions, order_col)
    encodings = [(col, dims[col], col, id_name) for col, id_name, _ in dimensions]
    return Star(encode_fact(df, encodings), dims, null_counts(flat))
