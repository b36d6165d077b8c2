"""Bounded, repeatable samples of labelled documents to train on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_label: tuple[int, int],
                    max_bytes: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """(text, label) of at most ``per_label`` documents of labels 0 and 1, by a
    hash of the id; ``allowed`` restricts the label rows.

    Texts longer than ``max_bytes`` and NULL texts or labels are not trained
    on, so the sample is at most sum(per_label) * max_bytes.  Of several labels
    of one id the largest counts; of several texts the first in order.
    """
    own = (labels.where(allowed & F.col(label).isNotNull()).groupBy(id_col)
           .agg((F.max(label) > 0).cast("int").alias("label")))
    usable = (docs.where(F.col(text_col).isNotNull() & (F.octet_length(text_col) <= max_bytes))
              .select(id_col).distinct().join(own, id_col))
    order = F.xxhash64(F.col(id_col))
    chosen = None
    for value in (0, 1):
        some = usable.where(F.col("label") == value).orderBy(order, id_col).limit(per_label[value])
        chosen = some if chosen is None else chosen.union(some)
    rows = (docs.select(id_col, F.col(text_col).alias("text")).where(F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes))
            .join(F.broadcast(chosen), id_col)  # at most sum(per_label) rows
            .groupBy(id_col).agg(F.min("text").alias("text"), F.max("label").alias("label")).collect())
    return [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: r[id_col])]


def bounded_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, per_label: tuple[int, int],
                   total_bytes: tuple[int, int], most_of_one: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, label) of labelled documents of every length, in the order of
    a hash of the id: at most ``per_label`` of labels 0 and 1, and as many as
    hold ``total_bytes`` together, where one text counts as ``most_of_one`` at
    most.

    NULL texts and labels are left out; ``allowed`` restricts the label rows.
    Of several labels of one id the largest counts; of several texts the first
    in order.
    """
    own = (labels.where(allowed & F.col(label).isNotNull()).groupBy(id_col)
           .agg((F.max(label) > 0).cast("int").alias("label")))
    texts = docs.select(id_col, F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    sizes = (texts.select(id_col, F.octet_length("text").cast("long").alias("size")).groupBy(id_col).agg(F.max("size").alias("size"))
             .join(own, id_col).withColumn("size", F.least("size", F.lit(most_of_one))))
    order = [F.xxhash64(F.col(id_col)), F.col(id_col)]
    upto = Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = None
    for value in (0, 1):
        some = sizes.where(F.col("label") == value).orderBy(*order).limit(per_label[value])  # the window's rows
        some = some.withColumn("held", F.sum("size").over(upto)).where(F.col("held") <= total_bytes[value])
        chosen = some if chosen is None else chosen.union(some)
    return (texts.join(F.broadcast(chosen.select(id_col, "label")), id_col)  # at most sum(per_label) rows
            .groupBy(id_col).agg(F.min("text").alias("text"), F.max("label").alias("label")))
