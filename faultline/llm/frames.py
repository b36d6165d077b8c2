"""DataFrame helpers of the operators."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: the
    lineage ends there, and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 4 << 20  # of an Arrow batch worked on at once


def small_batches(batch: pa.RecordBatch, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``limit`` bytes (a longer row goes alone)."""
    step = max(1, batch.num_rows * limit // max(batch.nbytes, limit))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def release_memory() -> None:
    """Give freed memory back: idle Python workers share their executor's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps what it has
        ctypes.CDLL(None).malloc_trim(0)


def _trim_jvm(spark: SparkSession) -> str | None:
    """``malloc_trim`` in the driver's JVM, by its diagnostic command: what
    compilers and codecs freed stays with the process otherwise.  What the
    command says; None from a JVM without it."""
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    kind = jvm.java.lang.Class.forName

    def array(of, *items):
        out = gateway.new_array(of, len(items))
        for i, item in enumerate(items):
            out[i] = item
        return out
    try:
        # by the interface's method: py4j finds none on the server's class, which is not public
        invoke = kind("javax.management.MBeanServer").getMethod("invoke", array(
            jvm.java.lang.Class, kind("javax.management.ObjectName"), kind("java.lang.String"),
            kind("[Ljava.lang.Object;"), kind("[Ljava.lang.String;")))
        commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        return invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(),
                             array(jvm.java.lang.Object, commands, "systemTrimNativeHeap", None, None))
    except Py4JError:
        return None


def release_driver(spark: SparkSession) -> None:
    """Drop what finished jobs left on the driver: arrays trained on, plans,
    and with them the shuffle files and broadcasts nobody can reach."""
    release_memory()
    gateway = getattr(spark, "_jvm", None)  # none behind Spark Connect
    if gateway is not None:
        gateway.System.gc()
        _trim_jvm(spark)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_go_at_once(spark: SparkSession) -> Iterator[None]:
    """Queries that start in here delete their shuffle files as they end.
    Otherwise the files stay until the driver collects the query's plan, which
    its listeners may still hold after ``release_driver``."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)


def written_step(df: DataFrame, name: str) -> DataFrame:
    """``written`` for one of many steps: its shuffle files and what it left on
    the driver go before the next one, so their garbage does not add up."""
    with shuffles_go_at_once(df.sparkSession):
        out = written(df, name)
    release_driver(df.sparkSession)
    return out


def add_columns(df: DataFrame, fields: list[T.StructField],
                compute: Callable[[pa.RecordBatch], list[pa.Array]]) -> DataFrame:
    """``df`` with the columns ``compute`` makes of each Arrow batch; columns
    of the same names are replaced."""
    new = {f.name.lower() for f in fields}
    keep = [c for c in df.columns if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in keep] + fields)

    def batches(it):
        for batch in (small for whole in it for small in small_batches(whole)):
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep] + compute(batch)
            yield pa.RecordBatch.from_arrays(columns, names=keep + [f.name for f in fields])
            del columns
            release_memory()

    return df.mapInArrow(batches, schema)
