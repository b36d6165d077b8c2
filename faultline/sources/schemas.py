"""The data model of the analysed records: table schemas and constraints.

Fixed values: tables, columns, types, keys and limits of the error-pattern
star schema, its feedback result table and the feedback rating table.
"""

from __future__ import annotations

from pyspark.sql.types import (IntegerType, StringType, StructField, StructType,
                               TimestampNTZType)

from ..operators.quality import Constraint


def _schema(*cols: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, False) for n, t in cols])


I, S = IntegerType(), StringType()

# Table schemas.
SCHEMAS: dict[str, StructType] = {
    "ErrorType": _schema(("error_type_id", I), ("type_name", S)),
    "ErrorSubtype": _schema(("subtype_id", I), ("subtype_name", S), ("error_type_id", I)),
    "Emotion": _schema(("emotion_id", I), ("emotion_name", S)),
    "SQLConcept": _schema(("concept_id", I), ("concept_name", S)),
    "LearningOutcome": _schema(("outcome_id", I), ("outcome_text", S)),
    "Submission": _schema(("submission_id", I), ("query_text", S), ("subtype_id", I), ("emotion_id", I),
                          ("concept_id", I), ("outcome_id", I), ("feedback_target", S)),
    "LLMFeedback": _schema(("feedback_id", I), ("subtype_id", I), ("example_submission_id", I),
                           ("model_name", S), ("prompt_text", S), ("generated_feedback", S),
                           ("frequency_rank", I), ("error_frequency", I), ("generated_at", TimestampNTZType())),
    "FeedbackEvaluation": _schema(("eval_id", I), ("feedback_id", I), ("rater_name", S), ("dimension", S),
                                  ("score", I)),
}

# Flat input records before preparation.
FLAT_RECORDS = _schema(("query", S), ("error_type", S), ("error_subtype", S), ("emotion", S),
                       ("feedback_target", S), ("intended_learning_outcome", S))


def _not_null(table: str) -> Constraint:
    return Constraint(table, "not_null", tuple(SCHEMAS[table].fieldNames()))


# Declared constraints (keys, references, limits, checks).
CONSTRAINTS: tuple[Constraint, ...] = (
    *(_not_null(t) for t in SCHEMAS),
    Constraint("ErrorType", "primary_key", ("error_type_id",)),
    Constraint("ErrorType", "unique", ("type_name",)),
    Constraint("ErrorType", "max_length", ("type_name",), 50),
    Constraint("ErrorSubtype", "primary_key", ("subtype_id",)),
    Constraint("ErrorSubtype", "unique", ("subtype_name",)),
    Constraint("ErrorSubtype", "max_length", ("subtype_name",), 100),
    Constraint("ErrorSubtype", "foreign_key", ("error_type_id",), ("ErrorType", ("error_type_id",))),
    Constraint("Emotion", "primary_key", ("emotion_id",)),
    Constraint("Emotion", "unique", ("emotion_name",)),
    Constraint("Emotion", "max_length", ("emotion_name",), 50),
    Constraint("SQLConcept", "primary_key", ("concept_id",)),
    Constraint("SQLConcept", "unique", ("concept_name",)),
    Constraint("SQLConcept", "max_length", ("concept_name",), 50),
    Constraint("LearningOutcome", "primary_key", ("outcome_id",)),
    Constraint("Submission", "primary_key", ("submission_id",)),
    Constraint("Submission", "foreign_key", ("subtype_id",), ("ErrorSubtype", ("subtype_id",))),
    Constraint("Submission", "foreign_key", ("emotion_id",), ("Emotion", ("emotion_id",))),
    Constraint("Submission", "foreign_key", ("concept_id",), ("SQLConcept", ("concept_id",))),
    Constraint("Submission", "foreign_key", ("outcome_id",), ("LearningOutcome", ("outcome_id",))),
    Constraint("LLMFeedback", "primary_key", ("feedback_id",)),
    Constraint("LLMFeedback", "unique", ("subtype_id",)),
    Constraint("LLMFeedback", "max_length", ("model_name",), 100),
    Constraint("LLMFeedback", "foreign_key", ("subtype_id",), ("ErrorSubtype", ("subtype_id",))),
    Constraint("LLMFeedback", "foreign_key", ("example_submission_id",), ("Submission", ("submission_id",))),
    Constraint("FeedbackEvaluation", "primary_key", ("eval_id",)),
    Constraint("FeedbackEvaluation", "max_length", ("rater_name",), 50),
    Constraint("FeedbackEvaluation", "max_length", ("dimension",), 30),
    Constraint("FeedbackEvaluation", "foreign_key", ("feedback_id",), ("LLMFeedback", ("feedback_id",))),
    Constraint("FeedbackEvaluation", "between", ("score",), (1, 4)),
)

# Referential actions of the foreign keys (child, parent, on delete).
ON_DELETE = {
    ("ErrorSubtype", "ErrorType"): "restrict",
    ("Submission", "ErrorSubtype"): "restrict",
    ("Submission", "Emotion"): "restrict",
    ("Submission", "SQLConcept"): "restrict",
    ("Submission", "LearningOutcome"): "restrict",
    ("LLMFeedback", "ErrorSubtype"): "restrict",
    ("LLMFeedback", "Submission"): "restrict",
    ("FeedbackEvaluation", "LLMFeedback"): "cascade",
}
