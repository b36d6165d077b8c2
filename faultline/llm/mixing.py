"""Mixing sources to target weights by weighted fair queueing (operator 3).

Every source queues its documents in a shuffled order, several times over if
it may be repeated.  A document's virtual finish time is the cumulative size of
its source up to and with it, divided by the source's weight.  All queues are
range-sorted by finish time and cut where the total budget is reached; sources
that run out leave their share to the others, which is the water-filling of
the targets.

DataFrame operations only.  Cumulative sums run over cells of a source (ranges
of the shuffle hash) with the cells' totals added, so a source holding a third
of all rows is spread like the rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .frames import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def _with_order(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    """Adds size, source key, shuffle hash and tie-break to every document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tie = F.md5(text.cast("binary"))  # in the shuffle hash too: rows without an id spread like others
    return docs.select(
        "*", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.when(F.col(source_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source_col).cast("string"))).alias("_source"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), tie).cast("binary")).alias("_shuffle"),
        tie.alias("_tie"))


def source_targets(sizes: DataFrame, share_percent: int, cap: int, weights: tuple[int, ...]) -> DataFrame:
    """Weights and targets of all sources, from (_source, source_size).

    One row a source goes through one window: sources are configuration, each
    with its weight.  Sources are capped in the order of capacity by weight as
    long as their share at the level of the rest exceeds their capacity.
    """
    by_name = Window.orderBy((F.col("_source") == "").cast("int"), "_source")
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") - 1) % len(weights) + 1)
    ranked = ranked.withColumn("_weight", weight.cast("long")).withColumn("_cap", F.col("source_size") * cap)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    upto = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = (ranked.withColumn("_budget", F.sum("source_size").over(everything) * share_percent / F.lit(100.0))
            .withColumn("_before", F.sum("_cap").over(upto) - F.col("_cap"))
            .withColumn("_rest", F.sum("_weight").over(everything) - F.sum("_weight").over(upto) + F.col("_weight"))
            .withColumn("_capped", F.col("_cap") * F.col("_rest") <= F.col("_weight") * (F.col("_budget") - F.col("_before"))))
    free = (F.col("_budget") - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)).over(everything))
    others = F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("_weight"))).over(everything)
    return full.select("_source", "source_size", "_rank", "_weight", "_budget",
                       F.when(F.col("_capped"), F.col("_cap").cast("double"))
                       .otherwise(F.col("_weight") * free / F.nullif(others, F.lit(0))).alias("target"))


def mix_sources(docs: DataFrame, share_percent: int = 150, cap: int = 2, weights: tuple[int, ...] = WEIGHTS,
                seed: str = "mix-1", id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source") -> DataFrame:
    """``docs`` with size, source_size, target, times and taken.

    Size is the number of runs of bytes other than space and line breaks.
    Sources, ordered by code point with NULL last, weigh ``weights`` in turn
    and share ``share_percent`` of all sizes; a target stops at ``cap`` times
    its source.  ``times`` says how often the document is in the mix, taken is
    times * size.  Whole documents are taken, so a source meets its target up
    to one document; the mix never exceeds the total budget.  NULL and empty
    texts have size 0 and are taken 0 times.  The order depends on id and text
    only: reruns agree, and equal rows are interchangeable.  An empty table
    gives an empty one; columns of the new names are replaced.
    """
    new = ("size", "source_size", "target", "times", "taken")
    kept = [c for c in docs.columns if c.lower() not in new]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    ordered = _with_order(docs, id_col, text_col, source_col, seed)
    narrow = written(ordered.select("_source", "size", "_shuffle", "_tie"), "mix-sizes")
    rows = narrow.count()
    cells = max(1, int(rows ** 0.5))
    # the first 32 bits of the shuffle hash, scaled: cells ascend with the hash
    cell = F.floor(F.conv(F.substring("_shuffle", 1, 8), 16, 10).cast("long") * cells / F.lit(float(1 << 32))).cast("int")

    totals = written(narrow.groupBy("_source", cell.alias("_cell")).agg(F.sum("size").alias("_cell_size")), "mix-cells")
    targets = source_targets(totals.groupBy("_source").agg(F.sum("_cell_size").alias("source_size")),
                             share_percent, cap, weights)
    before = Window.partitionBy("_source").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(totals.withColumn("_offset", F.coalesce(F.sum("_cell_size").over(before), F.lit(0)))
                      .join(targets, "_source"), "mix-offsets")

    in_cell = Window.partitionBy("_source", "_cell").orderBy("_shuffle", "_tie").rowsBetween(Window.unboundedPreceding, 0)

    def placed(frame: DataFrame) -> DataFrame:
        return (frame.withColumn("_cell", cell).join(offsets, ["_source", "_cell"])
                .withColumn("_upto", F.sum("size").over(in_cell) + F.col("_offset")))

    def finish(k: int) -> Column:
        return (F.col("source_size") * k + F.col("_upto")) / F.col("_weight").cast("double")

    position = ["_finish", "_rank", "_shuffle", "_tie"]
    passes = F.explode(F.array(*[finish(k) for k in range(cap)])).alias("_finish")
    queue = (placed(narrow.where("size > 0")).select(passes, "_rank", "_shuffle", "_tie", "size", "_budget")
             .repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *position)
             .withColumn("_range", F.spark_partition_id()))
    queue = written(queue, "mix-queue")
    ranges = queue.groupBy("_range").agg(F.sum("size").alias("_size"), F.max("_budget").alias("_budget"))
    held = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cut_range = (ranges.withColumn("_held", F.coalesce(F.sum("_size").over(held), F.lit(0)))
                 .where("_held + _size > _budget").orderBy("_range").limit(1).collect())
    if cut_range:  # inside the range where the budget ends: one of many, of about as many rows as each
        at = cut_range[0]
        running = Window.orderBy(*position).rowsBetween(Window.unboundedPreceding, 0)
        last = (queue.where(F.col("_range") == at["_range"])
                .withColumn("_held", F.sum("size").over(running) + F.lit(at["_held"]))
                .where(F.col("_held") <= F.lit(at["_budget"])).orderBy(*[F.desc(c) for c in position]).limit(1).collect())
        if not last:  # the whole range is beyond the budget: the last entry before it
            last = (queue.where(F.col("_range") < at["_range"])
                    .orderBy(*[F.desc(c) for c in position]).limit(1).collect())
        cut = F.struct(*[F.lit(last[0][c]).alias(c) for c in position]) if last else None

        def taken(k: int) -> Column:
            if cut is None:
                return F.lit(0)
            here = F.struct(finish(k).alias("_finish"), "_rank", "_shuffle", "_tie")
            return F.when(F.col("size") > 0, (here <= cut).cast("int")).otherwise(0)
    else:
        def taken(k: int) -> Column:
            return F.when(F.col("size") > 0, 1).otherwise(0)

    times = sum((taken(k) for k in range(1, cap)), taken(0))
    return (placed(ordered).withColumn("times", times)
            .select(*[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", "times",
                    (F.col("times") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does."""
    mix = mix_sources(docs, **options)
    return (mix.where("times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
