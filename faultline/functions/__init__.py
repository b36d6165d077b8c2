"""Column expressions shared by the operators."""

from .numeric import exact_percent, intdiv, round_ratio, share_exceeds
from .text import (CI_AI_COLLATION, char_length, collate_columns, escape_literal, left, preview,
                   render_template, strip_text, tokens)

__all__ = [
    "exact_percent", "intdiv", "round_ratio", "share_exceeds",
    "CI_AI_COLLATION", "collate_columns", "char_length", "escape_literal", "left", "preview", "render_template",
    "strip_text", "tokens",
]
