"""Column-level text helpers (all built-in Spark expressions, no UDFs)."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.split()`` and ``str.strip()``
# treat as whitespace.
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")
STRIP_CHARS = PY_WHITESPACE
# The same set as a pattern: Java's Unicode whitespace plus the four
# information separators (as fast as a plain ``\s+``).
_SPLIT_PATTERN = r"(?U)[\s\x1c-\x1f]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def char_length(c) -> Column:
    """Length in characters (code points), as BIGINT."""
    return F.length(_col(c)).cast("long")


def left(c, n: int) -> Column:
    """First ``n`` characters (SQL ``LEFT``)."""
    return F.left(_col(c), F.lit(n))


def preview(c, n: int, ellipsis: str = "...") -> Column:
    """``s[:n] + '...'`` when ``s`` is longer than ``n`` characters, else ``s``."""
    c = _col(c)
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit(ellipsis))).otherwise(c)


def escape_literal(c) -> Column:
    """Escape for a single-quoted SQL literal: backslash doubled, quote doubled."""
    c = _col(c)
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''"))


def strip_text(c) -> Column:
    """Remove surrounding whitespace (``str.strip``); plain ``trim`` only drops spaces."""
    return F.btrim(_col(c), F.lit(STRIP_CHARS))


def tokens(c) -> Column:
    """Lower-cased whitespace tokens of a text, empties removed (``str.split``)."""
    return F.array_remove(F.split(F.lower(_col(c)), _SPLIT_PATTERN), "")


def render_template(template: str, fields: Mapping[str, object]) -> Column:
    """Render a ``str.format``-style template with named fields as one concat.

    ``fields`` maps each placeholder name to a column (or column name).  The
    template is split once on the driver into literal pieces and field
    references; the rendering itself is a JVM ``concat`` per row, so values
    holding braces or percent signs are copied verbatim.  A NULL field gives a
    NULL result, like a failed lookup.
    """
    parts: list[Column] = []
    for literal, name, spec, conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is None:
            continue
        if spec or conv:
            raise ValueError(f"format spec/conversion not supported for field {name!r}")
        if name not in fields:
            raise KeyError(f"template field {name!r} has no column")
        parts.append(_col(fields[name]).cast("string"))
    return F.concat(*parts) if parts else F.lit("")


# Spark's collation matching MySQL's utf8mb4_unicode_ci grouping
# (case- and accent-insensitive, trailing spaces ignored).
CI_AI_COLLATION = "UNICODE_CI_AI_RTRIM"


def collate_columns(df, cols, collation: str = CI_AI_COLLATION):
    """Give string columns a collation; grouping, joins and equality then
    follow it (opt-in; the default is binary comparison)."""
    cols = set([cols] if isinstance(cols, str) else cols)
    return df.select(*[F.collate(F.col(c), collation).alias(c) if c in cols else F.col(c) for c in df.columns])
