"""Calls of an external text service: outcomes by row, and a log of calls that are not repeated.

A paid call is made once if its result is on disk before anything else can
fail.  ``logged_calls`` therefore deals the calls over many small tasks and
appends each task's results to a log table as the task ends (the file output
committer's second algorithm moves a task's file into the table when the task
commits, not when the job does).  A crash of the job, of a task or of an
executor loses the calls in flight and nothing else; the next run asks the log
first and calls what is missing.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from .ranking import rank_rows

LOG_SCHEMA = T.StructType([T.StructField("call_id", T.StringType()), T.StructField("input", T.StringType()),
                           T.StructField("output", T.StringType()), T.StructField("error", T.StringType()),
                           T.StructField("run", T.StringType()), T.StructField("called_at", T.TimestampType())])
COMMIT_BY_TASK = ("mapreduce.fileoutputcommitter.algorithm.version", "2")


class per_row:  # noqa: N801 - used like a function
    """Adapt a one-input service call to the batch interface."""

    def __init__(self, fn: Callable[[str], str]):
        self.fn = fn

    def __call__(self, inputs: pd.Series) -> pd.Series:
        return inputs.map(self.fn)


def outcomes(fn: Callable[[pd.Series], pd.Series], inputs: pd.Series, pause_seconds: float = 0.0) -> tuple[list, list]:
    """(outputs, errors) of a batch, a value each; see :func:`feedback.enrich_rows`."""

    def call(service, value):
        try:
            return service(value)
        finally:
            if pause_seconds:
                time.sleep(pause_seconds)

    def one(service, value):
        try:
            return call(service, value)
        except Exception as e:  # noqa: BLE001 - service errors vary
            return e

    def first(value):
        return list(fn(pd.Series([value])))[0]

    def values() -> list:
        if isinstance(fn, per_row):
            return [one(fn.fn, v) for v in inputs]
        try:
            found = list(call(fn, inputs))  # positional: the function's own index is ignored
            if len(found) != len(inputs):
                raise ValueError(f"batch function returned {len(found)} values for {len(inputs)} rows")
            return found
        except Exception:  # noqa: BLE001 - the batch as a whole failed
            return [one(first, v) for v in inputs]

    found = values()
    errors = [f"{type(v).__name__}: {v}" if isinstance(v, Exception) else None for v in found]
    return [None if e or v is None else str(v) for v, e in zip(found, errors)], errors


def call_id(input_col: str, model: str = "") -> Column:
    """Key of a call: digest of the model's name and the input; NULL for no input."""
    return F.sha2(F.concat(F.lit(f"{len(model)}:{model}"), F.col(input_col)), 256)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The calls at ``log_path``; an empty log is started where there is none."""
    spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(log_path)
    return spark.read.schema(LOG_SCHEMA).parquet(log_path)


def logged_calls(df: DataFrame, fn: Callable[[pd.Series], pd.Series], input_col: str, log_path: str,
                 output_col: str = "response", error_col: str = "error", model: str = "", calls_per_commit: int = 1,
                 pause_seconds: float = 0.0, drop_failed: bool = True) -> DataFrame:
    """``df`` with the service's answer to ``input_col``, every answer kept in
    the log at ``log_path`` as soon as it is there.

    Equal inputs are called once, and not at all if the log has an answer of
    the same ``model``; failures are logged and called again by the next run.
    ``calls_per_commit`` inputs go to one task and are committed together: at
    most that many answers are lost with a task, one by default.  ``fn`` and
    ``pause_seconds`` are those of :func:`feedback.enrich_rows`.  A row without
    input is a failure.  With ``drop_failed`` failed rows are left out.
    """
    spark = df.sparkSession
    shared_dir(spark)
    run = uuid.uuid4().hex
    keyed = df.withColumn("_call", call_id(input_col, model)).checkpoint(eager=True)  # inputs as they are called
    log = read_log(spark, log_path)
    wanted = keyed.filter(F.col("_call").isNotNull()).groupBy("_call").agg(F.any_value(input_col).alias("_input"))
    missing = wanted.join(log.filter(F.col("error").isNull()).select(F.col("call_id").alias("_call")), "_call", "left_anti")
    numbered = rank_rows(missing, ["_call"], out="_n", method="row_number").checkpoint(eager=True)
    if calls := numbered.count():
        tasks = -(-calls // calls_per_commit)
        dealt = numbered.repartitionById(tasks, F.expr(f"CAST((_n - 1) DIV {calls_per_commit} AS INT)")).select("_call", "_input")

        def answer(batches):
            for pdf in batches:
                output, error = outcomes(fn, pdf["_input"], pause_seconds)
                yield pd.DataFrame({"call_id": pdf["_call"], "input": pdf["_input"], "output": pd.Series(output, dtype=object),
                                    "error": pd.Series(error, dtype=object), "run": run, "called_at": pd.Timestamp.now(tz="UTC")})

        dealt.mapInPandas(answer, LOG_SCHEMA).write.mode("append").option(*COMMIT_BY_TASK).parquet(log_path)
    log = read_log(spark, log_path)  # files of this run included
    known = (log.filter(F.col("error").isNull() | (F.col("run") == run)).groupBy(F.col("call_id").alias("_call"))
             .agg(F.max_by(F.struct("output", "error"), F.struct(F.col("error").isNull(), F.col("called_at"))).alias("_r")))
    error = F.when(F.col("_call").isNull(), F.lit("no input")).otherwise(F.col("_r.error"))
    answered = (keyed.drop(output_col, error_col).join(known, "_call", "left")
                .withColumn(output_col, F.col("_r.output")).withColumn(error_col, error).drop("_r", "_call"))
    return answered.filter(F.col(error_col).isNull()) if drop_failed else answered
