"""DataFrame -> DataFrame operators."""

from .analysis import (conditional_split, crosstab_row_pct, difficulty_rank, distinct_sketches, dominant_member,
                       frequency_by_keys, group_count_mean, percent_of_total, ratio_from_sketches,
                       ratio_total_to_distinct, register_top_n_function, share_within_group, top_n_ranked,
                       united_sketches, value_counts)
from .calls import call_id, logged_calls, read_log
from .feedback import (clean_response, enrich_rows, feedback_job, feedback_report, feedback_run, feedback_worklist,
                       first_example_per_group, per_row)
from .inserts import KeyIndex, build_index, insert_checked, insert_report
from .joins import Dim, attach, checked_broadcast, fits, fits_each, join_null_safe
from .prepare import (build_dimension, build_dimensions, build_star, classify_by_keywords,
                      encode_fact, extend_dimension, filter_categories, load_star)
from .quality import (Constraint, cascade_delete, cascade_rekey, constraint_report, enforce, fk_violations,
                      functional_dependency, head_rows, length_violations, null_counts,
                      null_violations, orphan_keys, profile_columns, profile_shape, range_violations,
                      restrict_delete_blocked, schema_info, unique_violations)
from .ranking import rank_rows, sequence_ids
from .text import collocations, density_curve, density_curve_binned, histogram_equal_width, top_words, word_counts, word_weights

__all__ = [n for n in dir() if not n.startswith("_")]
