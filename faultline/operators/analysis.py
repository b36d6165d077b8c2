"""Frequency, share and ranking analyses over a fact table and its dimensions.

Every operator takes DataFrames and returns one.  Dimensions are attached with
:func:`faultline.operators.joins.attach` (checked broadcast, eager
aggregation below large dimensions); counts are partial-then-final
aggregations, so a key holding a third of the rows collapses to one row per
task before any shuffle.  Shares of a group total use an aggregate joined
back on the group key rather than a window, so no group's members must meet
in one window buffer; global ranks come from the distinct sort keys and their
counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import exact_percent, round_ratio, share_exceeds
from ..session import shared_dir
from .joins import DEFAULT_BROADCAST_MAX_ROWS, Dim, attach, join_null_safe

# Labels of the dominance query.
HIGH_LABEL = "High persistence"
LOW_LABEL = "Distributed"


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def _fact_cols(fact: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in fact.columns]


def frequency_by_keys(fact: DataFrame, keys: Sequence[str], dims: Sequence[Dim] = (),
                      out: str = "frequency", sort: bool = True,
                      broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """``COUNT(*)`` per combination of ``keys`` (fact or dimension columns).

    Sorted by the first key, then frequency descending, then the other keys.
    """
    keys = _list(keys)
    rows, w = attach(fact, dims, keep=_fact_cols(fact, keys), broadcast_max_rows=broadcast_max_rows)
    res = rows.groupBy(*keys).agg(w.count().alias(out))
    if sort:
        res = res.orderBy(F.col(keys[0]), F.col(out).desc(), *[F.col(k) for k in keys[1:]])
    return res


def _distinct_count(col: str, approx_rsd: float | None) -> Column:
    """Exact ``COUNT(DISTINCT col)``, or a HyperLogLog estimate with relative
    standard deviation ``approx_rsd`` (opt-in: no (key, value) shuffle)."""
    if approx_rsd is None:
        return F.count_distinct(col)
    return F.approx_count_distinct(col, rsd=approx_rsd)


def distinct_sketches(fact: DataFrame, keys: str | Sequence[str], distinct: str, out: str = "sketch",
                      log2_registers: int = 12) -> DataFrame:
    """Per key a row count (``total``) and a HyperLogLog sketch of the distinct
    ``distinct`` values, to be stored per load and united later.

    A sketch is 2**log2_registers registers at most, whatever it has seen; its
    estimate has a relative standard error of about 1.04 / sqrt(registers)
    (1.6 % for 12).  NULLs are not counted.
    """
    as_text = F.col(distinct).cast("string")
    return fact.groupBy(*_list(keys)).agg(F.count(F.lit(1)).alias("total"), F.hll_sketch_agg(as_text, log2_registers).alias(out))


def united_sketches(parts: DataFrame, keys: str | Sequence[str], sketch: str = "sketch") -> DataFrame:
    """Sketches of several loads as one per key: the same as a sketch of all rows."""
    return parts.groupBy(*_list(keys)).agg(F.sum("total").cast("long").alias("total"), F.hll_union_agg(sketch).alias(sketch))


def ratio_from_sketches(sketches: DataFrame, keys: str | Sequence[str], decimals: int = 2, total_name: str = "total",
                        distinct_name: str = "distinct_count", ratio_name: str = "ratio") -> DataFrame:
    """:func:`ratio_total_to_distinct` estimated from stored sketches."""
    rows = sketches.select(*_list(keys), F.col("total").alias(total_name),
                           F.hll_sketch_estimate("sketch").cast("long").alias(distinct_name))
    return rows.withColumn(ratio_name, round_ratio(total_name, distinct_name, decimals))


def ratio_total_to_distinct(fact: DataFrame, key: str | Sequence[str], distinct: str,
                            dims: Sequence[Dim] = (), decimals: int = 2,
                            total_name: str = "total", distinct_name: str = "distinct_count",
                            ratio_name: str = "ratio", sort: bool = True,
                            approx_rsd: float | None = None,
                            broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows per key, distinct ``distinct`` values per key and their ratio,
    ``ROUND(COUNT(*) / COUNT(DISTINCT x), decimals)`` half away from zero.
    ``approx_rsd`` switches to an approximate distinct count."""
    keys = _list(key)
    rows, w = attach(fact, dims, keep=_fact_cols(fact, keys + [distinct]),
                     broadcast_max_rows=broadcast_max_rows)
    res = (rows.groupBy(*keys)
               .agg(w.count().alias(total_name),
                    _distinct_count(distinct, approx_rsd).alias(distinct_name))
               .withColumn(ratio_name, round_ratio(total_name, distinct_name, decimals)))
    if sort:
        res = res.orderBy(F.col(ratio_name).desc(), *[F.col(k) for k in keys])
    return res


def dominant_member(fact: DataFrame, group: str | Sequence[str], member: str | Sequence[str],
                    threshold: float = 40, dims: Sequence[Dim] = (), decimals: int = 1,
                    count_name: str = "dominant_count", total_name: str = "total",
                    pct_name: str = "dominance_pct", label_name: str = "label",
                    labels: tuple[str, str] = (HIGH_LABEL, LOW_LABEL), sort: bool = True,
                    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Most frequent member(s) of each group with their share of the group.

    ``RANK() = 1`` semantics: every member tied at the top count is returned.
    The label is ``labels[0]`` when the *unrounded* share is strictly above
    ``threshold`` percent, else ``labels[1]``.

    Plan: counts per (group, member) [partial/final agg]; per-group total and
    top count [partial/final agg]; equi-join of the two on (group, count) -
    the join key includes the count, so a large group's members spread over
    many keys and only top members match.
    """
    g, m = _list(group), _list(member)
    rows, w = attach(fact, dims, keep=_fact_cols(fact, g + m), broadcast_max_rows=broadcast_max_rows)
    counts = rows.groupBy(*g, *m).agg(w.count().alias(count_name))
    stats = counts.groupBy(*g).agg(F.sum(count_name).cast("long").alias(total_name),
                                   F.max(count_name).alias(count_name))
    top = join_null_safe(counts, stats, [*g, count_name])
    res = top.select(
        *g, *m, count_name, total_name,
        exact_percent(count_name, total_name, decimals).alias(pct_name),
        F.when(share_exceeds(count_name, total_name, threshold), F.lit(labels[0]))
         .otherwise(F.lit(labels[1])).alias(label_name))
    if sort:
        res = res.orderBy(F.col(pct_name).desc(), *[F.col(c) for c in g + m])
    return res


def difficulty_rank(fact: DataFrame, key: str | Sequence[str], distinct: str,
                    category: str, categories: Mapping[str, str], dims: Sequence[Dim] = (),
                    total_name: str = "total", diversity_name: str = "diversity",
                    rank_name: str = "difficulty_rank", view: str | None = None,
                    approx_rsd: float | None = None,
                    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Per key: rows, distinct ``distinct``, rows per listed ``category``
    value (``categories`` maps value -> output column) and
    ``RANK() OVER (ORDER BY total DESC, diversity ASC)``.

    The result is ordered by the rank, which comes from the distinct counts
    (:func:`_rank_from_counts`); ``view`` registers it as a temporary view as
    well, a plan that is evaluated on every read.
    """
    keys = _list(key)
    rows, w = attach(fact, dims, keep=_fact_cols(fact, keys + [distinct, category]),
                     broadcast_max_rows=broadcast_max_rows)
    aggs = [w.count().alias(total_name), _distinct_count(distinct, approx_rsd).alias(diversity_name)]
    aggs += [w.count_if(F.col(category) == F.lit(v)).alias(name) for v, name in categories.items()]
    per_key = rows.groupBy(*keys).agg(*aggs)
    order = [F.col(total_name).desc(), F.col(diversity_name).asc()]
    per_key = per_key.select(*keys, total_name, diversity_name, *categories.values())
    if view:
        _rank_from_counts(per_key, total_name, diversity_name, rank_name).createOrReplaceTempView(view)
    shared_dir(fact.sparkSession)
    per_key = per_key.checkpoint(eager=True)  # a row per key, counted once and ranked
    return _rank_from_counts(per_key, total_name, diversity_name, rank_name).orderBy(rank_name, *keys)


def _rank_from_counts(per_key: DataFrame, total: str, diversity: str, rank: str) -> DataFrame:
    """``per_key`` with its rank by total (largest first) and diversity, as a
    plan that is evaluated on every read and gathers no keys in one task.

    Keys of equal total and diversity share a rank, so only the distinct pairs
    are ranked, and those in two steps: the keys of all larger totals, a
    running sum over distinct totals, plus the keys of this total and smaller
    diversity, a running sum inside the total.  Both are small whatever the
    keys: d distinct totals add up to d * d / 2 rows of the input at least, and
    a key of total t has a diversity of t at most.
    """
    pairs = per_key.groupBy(total, diversity).agg(F.count(F.lit(1)).alias("_k"))
    by_total = pairs.groupBy(total).agg(F.sum("_k").alias("_t"))
    before = Window.orderBy(F.col(total).desc()).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(total).orderBy(diversity).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (pairs.withColumn("_i", F.coalesce(F.sum("_k").over(inside), F.lit(0)))
             .join(by_total.select(total, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_b")), total)
             .select(total, diversity, (F.col("_b") + F.col("_i") + F.lit(1)).cast("long").alias(rank)))
    return per_key.join(ranks, [total, diversity]).select(*per_key.columns, rank)


def share_within_group(fact: DataFrame, group: str | Sequence[str], member: str | Sequence[str],
                       dims: Sequence[Dim] = (), decimals: int = 1, count_name: str = "count",
                       pct_name: str = "pct_within_group", sort: bool = True,
                       broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Count per (group, member) and its percentage of the group's total,
    ``ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY group), d)``.

    The group total is an aggregate joined back on the group key (AQE
    broadcasts it when small, splits a skewed group otherwise).
    """
    g, m = _list(group), _list(member)
    rows, w = attach(fact, dims, keep=_fact_cols(fact, g + m), broadcast_max_rows=broadcast_max_rows)
    counts = rows.groupBy(*g, *m).agg(w.count().alias(count_name))
    totals = counts.groupBy(*g).agg(F.sum(count_name).alias("_group_total"))
    res = (join_null_safe(counts, totals, g)
                 .select(*g, *m, count_name,
                         exact_percent(count_name, "_group_total", decimals).alias(pct_name)))
    if sort:
        res = res.orderBy(*[F.col(c) for c in g], F.col(count_name).desc(), *[F.col(c) for c in m])
    return res


def conditional_split(fact: DataFrame, key: str | Sequence[str], category: str,
                      first: str, second: str, dims: Sequence[Dim] = (), decimals: int = 1,
                      first_name: str = "first_count", second_name: str = "second_count",
                      total_name: str = "total", pct_name: str = "second_pct", sort: bool = True,
                      broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Per key: rows of two category values, all rows, and the second value's
    percentage of all rows (``SUM(CASE ...) * 100.0 / COUNT(*)``)."""
    keys = _list(key)
    rows, w = attach(fact, dims, keep=_fact_cols(fact, keys + [category]),
                     broadcast_max_rows=broadcast_max_rows)
    res = (rows.groupBy(*keys)
               .agg(w.count_if(F.col(category) == F.lit(first)).alias(first_name),
                    w.count_if(F.col(category) == F.lit(second)).alias(second_name),
                    w.count().alias(total_name))
               .withColumn(pct_name, exact_percent(second_name, total_name, decimals)))
    res = res.select(*keys, first_name, second_name, total_name, pct_name)
    if sort:
        res = res.orderBy(F.col(pct_name).desc(), *[F.col(k) for k in keys])
    return res


def top_n_ranked(fact: DataFrame, keys: str | Sequence[str], n: int, dims: Sequence[Dim] = (),
                 out: str = "frequency", rank_name: str = "rnk", method: str = "rank",
                 broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The ``n`` most frequent key combinations with their rank.

    ``ORDER BY frequency DESC LIMIT n`` with the keys as final tie-break (the
    reference's cut among equal counts is arbitrary).  Spark plans the limit as
    a per-partition top-n merged once (``TakeOrderedAndProject``), so at most
    n rows per task move.  A row's global rank only counts rows with a higher
    frequency, all of which are inside the top n, so ranking the n rows gives
    the global ``RANK()`` (or ``row_number`` with ``method``).
    """
    keys = _list(keys)
    rows, w = attach(fact, dims, keep=_fact_cols(fact, keys), broadcast_max_rows=broadcast_max_rows)
    counts = rows.groupBy(*keys).agg(w.count().alias(out))
    top = counts.orderBy(F.col(out).desc(), *[F.col(k) for k in keys]).limit(n)
    if method == "rank":
        fn, order = F.rank(), Window.orderBy(F.col(out).desc())
    else:
        fn, order = F.row_number(), Window.orderBy(F.col(out).desc(), *[F.col(k) for k in keys])
    # The window sees at most n rows (the limit), never the full group count.
    return (top.withColumn(rank_name, fn.over(order).cast("long"))
               .orderBy(F.col(out).desc(), *[F.col(k) for k in keys]))


TOP_N_BUCKETS = 256  # tasks that share the groups of the frequency where a top n ends


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def register_top_n_function(spark, name: str, view: str, keys: Sequence[str], key_types: Sequence[str],
                            out: str = "frequency", rank_name: str = "rnk") -> str:
    """Create the SQL table function ``name(top_n INT)`` over ``view``: the
    stored-procedure form of :func:`top_n_ranked` (``CALL proc(10)`` becomes
    ``SELECT * FROM name(10)``).

    ``LIMIT`` cannot take a parameter inside a SQL function.  The rank of a
    group depends on how many groups have a higher frequency, so the
    frequencies are counted and only those - a row per distinct frequency - are
    accumulated; the groups of the last frequency that fits in part are cut in
    key order, first in buckets by a hash of the key and then among what the
    buckets keep, at most ``top_n`` rows each.
    """
    ks = ", ".join(_ident(k) for k in keys)
    cols = ", ".join(f"{_ident(k)} {t}" for k, t in zip(keys, key_types))
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {_ident(name)}(top_n INT)
        RETURNS TABLE ({cols}, {_ident(out)} BIGINT, {_ident(rank_name)} BIGINT)
        RETURN
        WITH c AS (SELECT {ks}, COUNT(*) AS _f FROM {_ident(view)} GROUP BY {ks}),
        f AS (SELECT _f AS _g, COUNT(*) AS _k FROM c GROUP BY _f),
        r AS (SELECT _g, _k, SUM(_k) OVER (ORDER BY _g DESC ROWS UNBOUNDED PRECEDING) - _k AS _before FROM f),
        w AS (SELECT {ks}, _f, _before, _k FROM c JOIN r ON _f = _g WHERE _before < top_n),
        l AS (SELECT {ks}, _f, _before FROM
                  (SELECT *, ROW_NUMBER() OVER (PARTITION BY _f, pmod(xxhash64({ks}), {TOP_N_BUCKETS}) ORDER BY {ks}) AS _rn
                   FROM w WHERE _before + _k > top_n)
              WHERE _rn <= top_n - _before),
        t AS (SELECT {ks}, _f, _before FROM w WHERE _before + _k <= top_n
              UNION ALL
              SELECT {ks}, _f, _before FROM
                  (SELECT *, ROW_NUMBER() OVER (PARTITION BY _f ORDER BY {ks}) AS _rn FROM l)
              WHERE _rn <= top_n - _before)
        SELECT {ks}, _f, CAST(_before + 1 AS BIGINT) FROM t
    """)
    return name


def of_groups(condition: Column, count: str) -> Column:
    """``condition`` on group keys, looked at once a group: it reads the count
    too, so the optimizer does not move it below the aggregate, where a
    computed key would be computed a second time for every row."""
    return F.when(F.col(count) > 0, condition)


def value_counts(df: DataFrame, col: str | Sequence[str], out: str = "count",
                 n: int | None = None, dropna: bool = True) -> DataFrame:
    """``Series.value_counts()``: rows per value, descending (ties by value);
    ``n`` keeps the first n (``.head(n)``).  NULL is no value, unless
    ``dropna=False``."""
    cols = _list(col)
    res = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))
    if dropna:
        res = res.filter(of_groups(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]), out))
    res = res.orderBy(F.col(out).desc(), *[F.col(c) for c in cols])
    return res.limit(n) if n is not None else res


def percent_of_total(df: DataFrame, col: str | Sequence[str], decimals: int = 1,
                     out: str = "count", pct_name: str = "pct", dropna: bool = True) -> DataFrame:
    """Rows per value and their percentage of all rows with a value (pie-chart
    labels); ``dropna=False`` makes NULL a value.

    The grand total is a scalar subquery over the per-value counts - one
    partial/final aggregate, no cross join and no global window.
    """
    counts = value_counts(df, col, out=out, dropna=dropna)
    total = counts.select(F.sum(out)).scalar()
    return counts.withColumn(pct_name, exact_percent(F.col(out), total, decimals))


def crosstab_row_pct(df: DataFrame, row: str, col: str, values: Sequence, names: Sequence[str] | None = None,
                     decimals: int | None = None, other: str | None = None) -> DataFrame:
    """``pd.crosstab(row, col, normalize="index") * 100``.

    ``values`` fixes the pivot columns (no extra job to discover them; a
    missing cell is 0).  ``names`` renames them.  Unrounded shares are
    ``count / row_total * 100`` in double, as pandas computes them;
    ``decimals`` switches to exact rounding.  Rows with a NULL on either side
    count nowhere.  Other values share the column ``other``; without it they
    fail the job, so every row's shares make 100.
    """
    names = list(names) if names is not None else [f"{col}_{v}" for v in values]
    is_listed = F.col(col).isin(list(values))
    rows = df.dropna(subset=[row, col])
    if other is None:
        rows = rows.filter(F.when(is_listed, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("value not listed: "), F.col(col).cast("string"))).cast("boolean")))
    cells = [F.count_if(F.col(col) == F.lit(v)).alias(f"_c{i}") for i, v in enumerate(values)]
    if other is not None:
        cells.append(F.count_if(~is_listed).alias(f"_c{len(names)}"))
        names = names + [other]
    per = rows.groupBy(row).agg(F.count(F.lit(1)).alias("_row_total"), *cells)
    if decimals is None:
        shares = [(F.col(f"_c{i}") / F.col("_row_total") * F.lit(100.0)).alias(nm)
                  for i, nm in enumerate(names)]
    else:
        shares = [exact_percent(f"_c{i}", "_row_total", decimals).alias(nm) for i, nm in enumerate(names)]
    return per.select(row, *shares).orderBy(row)


def group_count_mean(df: DataFrame, key: str | Sequence[str], count_of: str, mean_of: Column | str,
                     count_name: str = "count", mean_name: str = "mean", dropna: bool = True) -> DataFrame:
    """``df.groupby(key).agg({count_of: "count", mean_of: "mean"})``: non-null
    count of one column and mean of another (or of an expression).  NULL keys
    are no group, unless ``dropna=False``."""
    keys = _list(key)
    mean_col = F.col(mean_of) if isinstance(mean_of, str) else mean_of
    rows = df.dropna(subset=keys) if dropna else df
    return (rows.groupBy(*keys)
              .agg(F.count(count_of).alias(count_name), F.avg(mean_col).alias(mean_name))
              .orderBy(*keys))
