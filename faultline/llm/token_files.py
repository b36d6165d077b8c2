"""Token ids as Parquet list columns that can be read selectively (operator 8).

``write_token_files`` lays documents out in ascending id order, one file per
range of ids, and lets Parquet hold the ids as a dictionary- or delta-encoded
integer list with chosen row-group and page sizes.  Page indexes (written by
default) and the ascending ids make reads of an id range touch only its pages;
the small columns (document id, length, place in the file) are read without
touching the ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .arrays import ragged
from .frames import add_columns, small_batches
from .vocabulary import text_encoder

ROW_GROUP_BYTES = 16 << 20   # a reader's and a writer's unit of memory
PAGE_BYTES = 256 << 10       # the unit a page index lets a reader skip
DICTIONARY_BYTES = 512 << 10  # holds the ids of a 50k vocabulary; beyond it, delta encoding

LAYOUT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()),
                       T.StructField("row", T.LongType()), T.StructField("offset", T.LongType()),
                       T.StructField("n_tokens", T.LongType()),
                       T.StructField("ids", T.ArrayType(T.IntegerType(), False))])


def _encode_in_order(tokenizer: str, end_id: int, text_col: str, id_col: str):
    def run(batches):
        part, row, offset = TaskContext.get().partitionId(), 0, 0
        for batch in (small for whole in batches for small in small_batches(whole)):
            n = batch.num_rows
            lists = text_encoder(tokenizer).encode(batch.column(batch.schema.get_field_index(text_col)))
            bounds = np.asarray(lists.offsets).astype(np.int64)
            sizes = np.diff(bounds) + 1
            ids = np.insert(np.asarray(lists.values), bounds[1:], end_id)
            ends = offset + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index(id_col)).cast(pa.int64()),
                pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)),
                pa.array(ends - sizes), pa.array(sizes), ragged(ids, sizes, pa.int32())], names=LAYOUT.fieldNames())
            row += n
            offset = int(ends[-1]) if n else offset
    return run


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text", dictionary: bool = True) -> None:
    """Write every whole text's ids, each followed by ``end_id``, under ``path``.

    Files hold ascending ids (NULL ids first); rows of one id keep an order by
    text.  NULL and empty texts have only the end id.  ``dictionary=False``
    delta-encodes all integers.  Columns: doc_id, part (the file), row and
    offset (rows and ids before it in the file), n_tokens, ids.
    """
    ordered = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    (ordered.mapInArrow(_encode_in_order(tokenizer, end_id, "text", "doc_id"), LAYOUT)
     .write.option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", str(dictionary).lower())
     .option("parquet.dictionary.page.size", DICTIONARY_BYTES)
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("compression", "zstd").parquet(path))


def read_token_files(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The documents under ``path`` with ``start``: ids of all documents before
    each.  Selecting columns or passing ``where`` (on doc_id, say) reads only
    those columns and the pages that may match.

    The starts need one number per file (its ids, summed in file order): two
    integers a file, broadcast.
    """
    files = spark.read.schema(LAYOUT).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    first = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))
    wanted = files if where is None else files.where(where)
    return wanted.join(F.broadcast(first), "part").withColumn("start", F.col("first") + F.col("offset")).drop("first")


def ids_crc32(tokens: DataFrame, ids_col: str = "ids", out: str = "ids_crc32") -> DataFrame:
    """``tokens`` with the CRC-32 of every id list as little-endian unsigned
    32-bit integers."""
    def crc(batch):
        column = batch.column(batch.schema.get_field_index(ids_col))
        bounds = np.asarray(column.offsets).astype(np.int64)
        raw = memoryview(np.asarray(column.values)[bounds[0]:bounds[-1]].astype("<u4").tobytes())
        at = (4 * (bounds - bounds[0])).tolist()
        return [pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:])], pa.int64())]
    return add_columns(tokens, [T.StructField(out, T.LongType())], crc)
