"""The analyses over the error-pattern star schema, with its column names.

``prepare_error_star`` turns flat annotated records into the six tables;
the query functions take those tables (a dict of DataFrames, e.g. read from
parquet) and return the analyses with the output columns users of the
schema expect.  Everything is composed from the generic operators.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analysis as A
from ..operators import feedback as FB
from ..operators import prepare as P
from ..operators.joins import Dim
from ..operators.ranking import sequence_ids

Tables = Mapping[str, DataFrame]

# The two error categories kept for analysis.
KEPT_TYPES = ("syntax", "schema")


def prepare_error_star(flat: DataFrame, keep_types=KEPT_TYPES, order=None) -> dict[str, DataFrame]:
    """Flat records (``query, error_type, error_subtype, emotion,
    feedback_target, intended_learning_outcome``) -> the six tables.

    Rows are numbered in ingest order (``submission_id`` 1..n): by the column(s)
    ``order``, else by file name and position in the file; concepts come
    from the keyword ladder; type, subtype, emotion and concept ids follow the
    sorted names, outcome ids the first appearance.  Each subtype takes the
    type id of its rows (the subtype -> type dependency is checked by
    ``quality.functional_dependency``).
    """
    # Classified before the rows are numbered (and materialised): each text is searched once.
    kept = P.classify_by_keywords(P.filter_categories(flat, "error_type", keep_types), "query", out="concept")
    kept = sequence_ids(kept, "submission_id", order)
    dims = P.build_dimensions(kept, [("error_type", "error_type_id", "sorted"),
                                     ("error_subtype", "subtype_id", "sorted"),
                                     ("emotion", "emotion_id", "sorted"),
                                     ("concept", "concept_id", "sorted"),
                                     ("intended_learning_outcome", "outcome_id", "first_seen")],
                              order_col="submission_id")
    error_type = dims["error_type"].select("error_type_id", F.col("error_type").alias("type_name"))
    pairs = kept.select("error_subtype", "error_type").distinct()
    subtype = (dims["error_subtype"].join(pairs, "error_subtype")
               .join(dims["error_type"], "error_type")
               .select("subtype_id", F.col("error_subtype").alias("subtype_name"), "error_type_id"))
    fact = P.encode_fact(
        kept.select("submission_id", "query", "error_subtype", "emotion", "concept",
                        "intended_learning_outcome", "feedback_target"),
        [("error_subtype", dims["error_subtype"], "error_subtype", "subtype_id"),
         ("emotion", dims["emotion"], "emotion", "emotion_id"),
         ("concept", dims["concept"], "concept", "concept_id"),
         ("intended_learning_outcome", dims["intended_learning_outcome"], "intended_learning_outcome",
          "outcome_id")])
    return {
        "ErrorType": error_type,
        "ErrorSubtype": subtype,
        "Emotion": dims["emotion"].select("emotion_id", F.col("emotion").alias("emotion_name")),
        "SQLConcept": dims["concept"].select("concept_id", F.col("concept").alias("concept_name")),
        "LearningOutcome": dims["intended_learning_outcome"].select(
            "outcome_id", F.col("intended_learning_outcome").alias("outcome_text")),
        "Submission": fact.select("submission_id", F.col("query").alias("query_text"), "subtype_id",
                                  "emotion_id", "concept_id", "outcome_id", "feedback_target"),
    }


def _subtype_with_type(t: Tables) -> DataFrame:
    return t["ErrorSubtype"].join(t["ErrorType"], "error_type_id").select(
        "subtype_id", "subtype_name", "type_name")


def _dims(t: Tables, concept=True, subtype=True, emotion=False) -> list[Dim]:
    out = []
    if concept:
        out.append(Dim(t["SQLConcept"], on="concept_id", columns=["concept_name"]))
    if subtype:
        out.append(Dim(_subtype_with_type(t), on="subtype_id", columns=["subtype_name", "type_name"]))
    if emotion:
        out.append(Dim(t["Emotion"], on="emotion_id", columns=["emotion_name"]))
    return out


def frequency_by_concept(t: Tables) -> DataFrame:
    """Frequency of each subtype (with its type) within each concept."""
    res = A.frequency_by_keys(t["Submission"], ["concept_name", "subtype_name", "type_name"], _dims(t))
    return res.select(F.col("concept_name").alias("sql_concept"), F.col("subtype_name").alias("error_subtype"),
                      F.col("type_name").alias("error_type"), "frequency")


def errors_per_subtype(t: Tables) -> DataFrame:
    """Errors per concept, distinct subtypes, and errors per subtype (2 decimals)."""
    res = A.ratio_total_to_distinct(t["Submission"], "concept_name", "subtype_id", _dims(t, subtype=False),
                                    total_name="total_errors", distinct_name="distinct_subtypes",
                                    ratio_name="avg_errors_per_subtype")
    return res.withColumnRenamed("concept_name", "sql_concept")


def dominant_subtype(t: Tables, threshold: float = 40) -> DataFrame:
    """Top subtype(s) of each concept, share of the concept, persistence label.

    Ranked on ids; names are looked up afterwards, for the top rows only."""
    ranked = A.dominant_member(t["Submission"], "concept_id", "subtype_id", threshold,
                               count_name="dominant_count", total_name="total_errors",
                               pct_name="dominance_pct", label_name="persistence_label", sort=False)
    named = (ranked.join(t["SQLConcept"], "concept_id").join(t["ErrorSubtype"], "subtype_id")
             .select("concept_name", F.col("subtype_name").alias("dominant_subtype"), "dominant_count",
                     "total_errors", "dominance_pct", "persistence_label"))
    return named.orderBy(F.col("dominance_pct").desc(), "concept_name", "dominant_subtype")


def concept_difficulty(t: Tables, view: str | None = "v_concept_difficulty") -> DataFrame:
    """Rank concepts by errors (desc) then subtype diversity (asc); also a view."""
    return A.difficulty_rank(t["Submission"], "concept_name", "subtype_id", "type_name",
                             {"syntax": "syntax_errors", "schema": "schema_errors"}, _dims(t),
                             total_name="total_errors", diversity_name="subtype_diversity", view=view)


def emotion_by_subtype(t: Tables) -> DataFrame:
    """Emotions within each subtype, with their share (1 decimal)."""
    return A.share_within_group(t["Submission"], "subtype_name", "emotion_name",
                                _dims(t, concept=False, emotion=True), count_name="count",
                                pct_name="pct_within_subtype")


def schema_vs_syntax(t: Tables) -> DataFrame:
    """Syntax and schema errors per concept and the schema share (1 decimal)."""
    return A.conditional_split(t["Submission"], "concept_name", "type_name", "syntax", "schema", _dims(t),
                               first_name="syntax_count", second_name="schema_count", total_name="total",
                               pct_name="schema_pct")


def top_error_subtypes(t: Tables, top_n: int) -> DataFrame:
    """The ``top_n`` most frequent subtypes with type, frequency and rank."""
    res = A.top_n_ranked(t["Submission"], ["subtype_name", "type_name"], top_n,
                         _dims(t, concept=False), out="frequency", rank_name="rnk")
    return res.select("subtype_name", F.col("type_name").alias("error_type"), "frequency", "rnk")


def top_patterns(t: Tables, n: int) -> DataFrame:
    """Top subtypes by frequency with id, name and type (worklist input)."""
    res = A.top_n_ranked(t["Submission"], ["subtype_id"], n, out="frequency", rank_name="frequency_rank",
                         method="row_number")
    return (res.join(_subtype_with_type(t), "subtype_id")
               .select("subtype_id", "subtype_name", "type_name", "frequency", "frequency_rank")
               .orderBy("frequency_rank"))


def examples(t: Tables) -> DataFrame:
    """First submission of every subtype with its query, concept and outcome."""
    return FB.first_example_per_group(
        t["Submission"], "subtype_id", "submission_id", ["query_text", "concept_id", "outcome_id"],
        dims=[Dim(t["SQLConcept"], on="concept_id", columns=["concept_name"]),
              Dim(t["LearningOutcome"], on="outcome_id", columns=["outcome_text"])])


# SQL names users of the schema call.
DIFFICULTY_VIEW = "v_concept_difficulty"
TOP_SUBTYPES_FUNCTION = "GetTopErrorSubtypes"


def register_sql(spark, t: Tables) -> list[str]:
    """Expose the star to SQL: the six tables as temporary views, the
    difficulty view, and the top-N procedure as a table function
    (``SELECT * FROM GetTopErrorSubtypes(10)``).  Returns the names."""
    names = []
    for name, df in t.items():
        df.createOrReplaceTempView(name)
        names.append(name)
    concept_difficulty(t, view=DIFFICULTY_VIEW)
    t["Submission"].join(_subtype_with_type(t), "subtype_id").select(
        "subtype_name", F.col("type_name").alias("error_type")).createOrReplaceTempView("_submission_subtypes")
    A.register_top_n_function(spark, TOP_SUBTYPES_FUNCTION, "_submission_subtypes",
                              ["subtype_name", "error_type"], ["STRING", "STRING"])
    return names + [DIFFICULTY_VIEW, TOP_SUBTYPES_FUNCTION]


def profile_records(flat: DataFrame, bins: int = 40) -> dict[str, DataFrame]:
    """The exploratory profile of flat records: one DataFrame per aggregate
    behind a chart or printout (all lazy; each reads only its columns).

    ``emotion_types`` lists the emotions found, a small separate job, to fix
    the crosstab columns; pass the records through ``checkpoint`` first when
    the input is expensive to recompute.
    """
    from ..operators import quality as Q
    from ..operators import text as TX

    length = F.length(F.col("feedback_target").cast("string"))
    with_len = flat.withColumn("feedback_length", length)
    emotions = [r[0] for r in flat.select("emotion").dropna().distinct().orderBy("emotion").limit(MOST_COLUMNS + 1).collect()]
    if len(emotions) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} emotions: no columns of a cross tabulation")
    return {
        "shape": Q.profile_shape(flat),
        "head": Q.head_rows(flat, flat.columns[0], 5),
        "info": Q.schema_info(flat),
        "describe": Q.profile_columns(flat),
        "nulls": Q.null_counts(flat),
        "error_types": A.value_counts(flat, "error_type"),
        "top_subtypes": A.value_counts(flat, "error_subtype", n=10),
        "emotion_shares": A.percent_of_total(flat, "emotion"),
        "top_words": TX.top_words(flat.filter(F.col("feedback_target").isNotNull()), "feedback_target", 20),
        "word_weights": TX.word_weights(flat, "feedback_target", 200),
        "length_histogram": TX.histogram_equal_width(with_len, "feedback_length", bins),
        "length_density": TX.density_curve(with_len, "feedback_length", count_bins=bins),
        "type_by_emotion_pct": A.crosstab_row_pct(flat, "error_type", "emotion", emotions, names=emotions),
        "length_by_type": A.group_count_mean(with_len, "error_type", "query", "feedback_length",
                                             count_name="count", mean_name="avg_feedback_length"),
    }


# The feedback prompt template, with its five named fields.
FEEDBACK_TEMPLATE = """A student practicing the SQL concept "{concept}" made an error.

Error category: {error_type}
Error pattern: {subtype}

The student submitted this query:
{query}

Correct expectation (what they should learn): {outcome}

Write the feedback message this student would receive."""

MOST_COLUMNS = 1000  # of a cross tabulation, a column per value

FEEDBACK_FIELDS = {"concept": "concept_name", "error_type": "type_name", "subtype": "subtype_name",
                   "query": "query_text", "outcome": "outcome_text"}


def generate_feedback(t: Tables, service, out_path: str, table_path: str | None = None, top_n: int = 5,
                      model_name: str = "", template: str = FEEDBACK_TEMPLATE, now=None,
                      pause_seconds: float = 0.0, log_path: str | None = None) -> DataFrame:
    """The feedback run over the star: the ``top_n`` subtypes, their first
    submission with concept and outcome, the rendered prompt, the caller's
    ``service`` (a batch function, see ``feedback.per_row`` for one-prompt
    calls), an upsert keyed by ``subtype_id`` into a new version of the
    result table at ``out_path`` (merged with ``table_path`` if given), and
    the report: rank, subtype name, frequency and a 70-character preview.
    With ``log_path`` every answer is kept there as soon as it is there.
    """
    from ..operators.calls import logged_calls
    from ..sources.schemas import SCHEMAS
    from ..sources.tables import upsert_by_key
    from ..functions.text import strip_text

    spark = t["Submission"].sparkSession
    work = FB.feedback_worklist(
        t["Submission"], "subtype_id", top_n, "submission_id", template, FEEDBACK_FIELDS,
        example_columns=["query_text", "concept_id", "outcome_id"],
        example_dims=[Dim(t["SQLConcept"], on="concept_id", columns=["concept_name"]),
                      Dim(t["LearningOutcome"], on="outcome_id", columns=["outcome_text"])],
        group_dims=[Dim(_subtype_with_type(t), on="subtype_id", columns=["subtype_name", "type_name"])],
        example_name="example_submission_id")
    if log_path:
        done = logged_calls(work, service, "prompt", log_path, "generated_feedback", model=model_name, pause_seconds=pause_seconds)
    else:
        done = FB.enrich_rows(work, service, "prompt", output_col="generated_feedback", pause_seconds=pause_seconds)
    rows = done.select("subtype_id", "example_submission_id", F.lit(model_name).alias("model_name"),
                       F.col("prompt").alias("prompt_text"),
                       strip_text("generated_feedback").alias("generated_feedback"),
                       "frequency_rank", F.col("frequency").alias("error_frequency"))
    old = (spark.read.parquet(table_path) if table_path
           else spark.createDataFrame([], SCHEMAS["LLMFeedback"]))
    merged = upsert_by_key(old, rows, "subtype_id", id_col="feedback_id", touched_col="generated_at", now=now)
    merged.write.mode("errorifexists").parquet(out_path)
    stored = spark.read.parquet(out_path)
    return FB.feedback_report(stored, "frequency_rank", "generated_feedback", ["subtype_name", "error_frequency"],
                              dims=[Dim(t["ErrorSubtype"], on="subtype_id", columns=["subtype_name"])])
