"""Worklist of the most frequent patterns, enrichment and result report.

The reference loops on the client: top-N patterns, then one query per
pattern for its first example, a formatted prompt, a service call, an upsert.
Here the loop is one plan: the top-N (at most n rows, broadcast) filters the
fact, one partial/final ``min_by`` picks every example, names are joined
late, and the prompt is a JVM ``concat``.  The service call runs inside
``mapInPandas`` with a caller-supplied batch function.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType

from ..functions.text import left, render_template, strip_text
from ..session import shared_dir
from .calls import logged_calls, outcomes, per_row
from .joins import DEFAULT_BROADCAST_MAX_ROWS, Dim, attach, checked_broadcast, join_null_safe


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def first_example_per_group(fact: DataFrame, group: str | Sequence[str], order_col: str,
                            columns: Sequence[str] = (), dims: Sequence[Dim] = (),
                            broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The row with the lowest ``order_col`` in every group (``ORDER BY id LIMIT 1``
    per group), with ``columns`` of that row; ``dims`` are joined afterwards,
    to one row per group only.

    ``min_by`` over a struct is a partial/final aggregate: a group holding a
    third of the fact still reduces to one candidate per task.
    """
    g = _list(group)
    cols = [c for c in columns if c not in g and c != order_col]
    best = (fact.groupBy(*g)
                .agg(F.min_by(F.struct(F.col(order_col), *[F.col(c) for c in cols]), F.col(order_col))
                      .alias("_ex"))
                .select(*g, "_ex.*"))
    if dims:
        best, _ = attach(best, dims, keep=best.columns, broadcast_max_rows=broadcast_max_rows)
    return best


def feedback_worklist(fact: DataFrame, group: str | Sequence[str], n: int, order_col: str,
                      template: str, fields: Mapping[str, str], example_columns: Sequence[str] = (),
                      example_dims: Sequence[Dim] = (), group_dims: Sequence[Dim] = (),
                      rank_name: str = "frequency_rank", frequency_name: str = "frequency",
                      example_name: str = "example_id", prompt_name: str = "prompt",
                      broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """One row per top-``n`` group: sequential rank (``enumerate``), frequency,
    first example and the rendered prompt.

    Plan: one scan of (group, order id) computes every group's count and
    smallest id (partial/final aggregate); the top ``n`` groups are joined with
    the fact on (group, id), so the wide example columns travel for those rows
    only.  Nothing is collected; Spark and AQE choose the joins from sizes.

    Groups without an example cannot occur (every counted group has rows); a
    NULL template field makes the prompt NULL and such a row is dropped, as
    the reference skips a pattern without an example.  Rank numbers are
    assigned before that filter, so gaps stay visible.
    """
    g = _list(group)
    stats = fact.groupBy(*g).agg(F.count(F.lit(1)).alias(frequency_name), F.min(order_col).alias("_first"))
    top = stats.orderBy(F.col(frequency_name).desc(), *[F.col(c) for c in g]).limit(n)
    shared_dir(fact.sparkSession)
    top = top.checkpoint(eager=True)  # at most n rows, computed once for both of its uses
    first = top.select(*g, F.col("_first").alias(order_col))
    candidates = join_null_safe(fact, first, [*g, order_col], how="left_semi")
    top = top.drop("_first").withColumn(rank_name, F.row_number().over(
        Window.orderBy(F.col(frequency_name).desc(), *[F.col(c) for c in g])).cast("long"))
    if group_dims:
        top, _ = attach(top, group_dims, keep=top.columns, broadcast_max_rows=broadcast_max_rows)
    examples = first_example_per_group(candidates, g, order_col, example_columns, example_dims,
                                       broadcast_max_rows)
    examples = examples.withColumnRenamed(order_col, example_name)
    rows = join_null_safe(top, examples, g)
    cols = {k: F.col(v) for k, v in fields.items()}
    rows = rows.withColumn(prompt_name, render_template(template, cols))
    return rows.filter(F.col(prompt_name).isNotNull()).orderBy(rank_name)


def enrich_rows(df: DataFrame, fn: Callable[[pd.Series], pd.Series], input_col: str,
                output_col: str = "response", error_col: str = "error",
                drop_failed: bool = True, materialize: bool = True,
                pause_seconds: float = 0.0, tasks: int | None = None) -> DataFrame:
    """Apply a caller-supplied *batch* function to ``input_col`` in the executors.

    ``fn`` maps a pandas Series of inputs to a Series of outputs (one client
    per Python worker, batches of Arrow rows).  A value that is an exception
    is that row's failure.  A batch function that raises says nothing about
    its rows, so they are called one by one; a one-prompt function
    (:class:`per_row`) is called once a row and no success is repeated.  A
    failing row gets ``error_col`` set and, with ``drop_failed``, is skipped
    like the reference's ``continue``.

    ``pause_seconds`` waits after every call of the service in a worker (a
    rate limit per client): after each prompt for a one-prompt function.

    The rows are dealt over ``tasks`` tasks (default: the shuffle partitions),
    since a sorted and limited worklist arrives in one; the order of the
    result is not that of ``df``.  With ``materialize`` the enriched rows are
    checkpointed into the shared folder at once, so later actions (an upsert
    reads its input twice) never call the service again; only a retried task
    repeats its calls.  Where calls cost, use :func:`calls.logged_calls`.
    """
    schema = StructType(list(df.schema.fields) + [StructField(output_col, StringType(), True),
                                                  StructField(error_col, StringType(), True)])

    def run(batches):
        for pdf in batches:
            values, errors = outcomes(fn, pdf[input_col], pause_seconds)
            yield pdf.assign(**{output_col: pd.Series(values, index=pdf.index, dtype=object),
                                error_col: pd.Series(errors, index=pdf.index, dtype=object)})

    spread = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    res = df.repartition(spread).mapInPandas(run, schema)
    if materialize:
        shared_dir(df.sparkSession)
        res = res.checkpoint(eager=True)
    if drop_failed:
        res = res.filter(F.col(error_col).isNull())
    return res


def clean_response(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Strip surrounding whitespace from a generated text (``.strip()``)."""
    return df.withColumn(out or col, strip_text(col))


def feedback_report(results: DataFrame, rank_col: str, text_col: str, columns: Sequence[str],
                    dims: Sequence[Dim] = (), preview_chars: int = 70, preview_name: str = "preview",
                    broadcast_max_rows: int | None = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Stored results with names and a ``LEFT(text, preview_chars)`` preview, by rank."""
    rows = results
    if dims:  # names for the report, one lookup per stored row
        for d in dims:
            rows = rows.join(checked_broadcast(d.projected(), broadcast_max_rows),
                             on=[d.on] if isinstance(d.on, str) else list(d.on), how="inner")
    return (rows.select(F.col(rank_col), *[F.col(c) for c in columns],
                        left(text_col, preview_chars).alias(preview_name))
                .orderBy(rank_col, *columns))


def feedback_job(fact: DataFrame, group: str | Sequence[str], n: int, order_col: str, template: str,
                 fields: Mapping[str, str], service: Callable[[pd.Series], pd.Series], out_path: str,
                 table_path: str | None = None, model_name: str = "", example_columns: Sequence[str] = (),
                 example_dims: Sequence[Dim] = (), group_dims: Sequence[Dim] = (),
                 report_columns: Sequence[str] = (), now=None, preview_chars: int = 70,
                 mode: str = "errorifexists", pause_seconds: float = 0.0,
                 log_path: str | None = None, calls_per_commit: int = 1) -> DataFrame:
    """The whole feedback run: worklist -> service -> upsert -> report.

    Rows of the result table: ``feedback_id``, the group key, example id,
    model name, prompt, generated text, rank, frequency and time.  The
    current table at ``table_path`` (none on the first run) is merged by the
    group key and written as a new version at ``out_path``; the report is
    read from that version, ordered by rank.  Patterns whose service call
    failed are skipped and keep their previous row, if any.  ``mode`` is the
    write mode of the new version (never the folder being read).  With
    ``log_path`` every answer is kept in that log as soon as it is there, and a
    run after a crash calls only what the log has no answer to.
    """
    from ..sources.tables import upsert_by_key

    spark = fact.sparkSession
    g = _list(group)
    rows = _feedback_rows(fact, g, n, order_col, template, fields, service, model_name, example_columns, example_dims,
                          group_dims, pause_seconds, log_path, calls_per_commit)
    old = spark.read.parquet(table_path) if table_path else spark.createDataFrame([], _result_schema(rows))
    if table_path and table_path.rstrip("/") == out_path.rstrip("/"):
        raise ValueError("write the new version to a new path, not over its input")
    merged = upsert_by_key(old, rows, g, id_col="feedback_id", touched_col="generated_at", now=now)
    merged.write.mode(mode).parquet(out_path)
    stored = spark.read.parquet(out_path)
    return feedback_report(stored, "frequency_rank", "generated_feedback",
                           [*g, *report_columns, "error_frequency"], preview_chars=preview_chars)


def _feedback_rows(fact, g, n, order_col, template, fields, service, model_name, example_columns, example_dims, group_dims,
                   pause_seconds, log_path, calls_per_commit) -> DataFrame:
    """Worklist and answers as rows of the result table, without id and time."""
    work = feedback_worklist(fact, g, n, order_col, template, fields, example_columns, example_dims,
                             group_dims)
    if log_path:
        done = logged_calls(work, service, "prompt", log_path, "generated_feedback", model=model_name,
                            calls_per_commit=calls_per_commit, pause_seconds=pause_seconds)
    else:
        done = enrich_rows(work, service, "prompt", output_col="generated_feedback", pause_seconds=pause_seconds)
    return done.select(*g, F.col("example_id").cast("long").alias("example_id"),
                       F.lit(model_name).alias("model_name"), F.col("prompt").alias("prompt_text"),
                       strip_text("generated_feedback").alias("generated_feedback"),
                       F.col("frequency_rank").cast("long").alias("frequency_rank"),
                       F.col("frequency").cast("long").alias("error_frequency"))


def _result_schema(rows: DataFrame) -> StructType:
    return StructType([StructField("feedback_id", LongType()), *rows.schema.fields, StructField("generated_at", TimestampNTZType())])


def feedback_run(fact: DataFrame, group: str | Sequence[str], n: int, order_col: str, template: str,
                 fields: Mapping[str, str], service: Callable[[pd.Series], pd.Series], store_path: str,
                 model_name: str = "", example_columns: Sequence[str] = (), example_dims: Sequence[Dim] = (),
                 group_dims: Sequence[Dim] = (), report_columns: Sequence[str] = (), now=None, preview_chars: int = 70,
                 pause_seconds: float = 0.0, calls_per_commit: int = 1, partitions: int = 16) -> DataFrame:
    """:func:`feedback_job` over one folder that grows from run to run.

    ``store_path`` holds the result table as a keyed table, started by the
    first run with ``partitions`` partitions, and the log of calls.  Every
    answer is in the log as soon as it is there; results are merged into the
    partitions of their keys.  A run that was interrupted anywhere is simply
    repeated: it calls what the log lacks and merges the rest.  The report
    lists the patterns of this run's worklist.
    """
    from ..sources import keyed as K

    spark, g, store = fact.sparkSession, _list(group), store_path.rstrip("/")
    shared_dir(spark)
    rows = _feedback_rows(fact, g, n, order_col, template, fields, service, model_name, example_columns, example_dims,
                          group_dims, pause_seconds, f"{store}/calls", calls_per_commit).checkpoint(eager=True)
    table = K.open_or_create(spark, f"{store}/results", _result_schema(rows), g, partitions, id_col="feedback_id")
    parts = K.merge_keyed(spark, table, rows, touched_col="generated_at", now=now)
    mine = join_null_safe(K.partitions_read(spark, table, parts).drop(K.PART), rows.select(*g), g, how="left_semi")
    return feedback_report(mine, "frequency_rank", "generated_feedback",
                           [*g, *report_columns, "error_frequency"], preview_chars=preview_chars)
