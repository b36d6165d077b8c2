"""Exact percentage and ratio expressions.

Rounding a double (``round(x, 2)``) differs between engines at halves
(1.005, 0.285 ...).  The reference rounds exact decimals half away from zero,
so every rounded share here is computed on integers:

    round(100 * c / t, k) == ((2 * 10**k * 100 * c + t) div (2 * t)) / 10**k

for non-negative counts ``c`` and positive ``t``.  The final division by a
power of ten yields the same IEEE double in any engine.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def intdiv(a, b) -> Column:
    """Integral division (SQL ``a div b``), exact on longs."""
    return F.call_function("div", _col(a), _col(b))


def round_ratio(num, den, decimals: int = 2, scale: int = 1) -> Column:
    """``round(scale * num / den, decimals)`` half away from zero, exact.

    ``num`` and ``den`` must be non-negative integer columns.  The result is
    a DOUBLE; a zero denominator gives NULL (as SQL division by zero does in
    the reference's database) instead of an error.
    """
    # Wide integers: 2 * 10**k * scale * num stays exact for any row count.
    big = "decimal(38,0)"
    num, den = _col(num).cast(big), _col(den).cast(big)
    p = 10 ** decimals
    q = intdiv(F.lit(str(2 * p * scale)).cast(big) * num + den, F.lit(2).cast(big) * den).cast("long")
    return F.when(den == 0, F.lit(None).cast("double")).otherwise((q / F.lit(p)).cast("double"))


def exact_percent(count, total, decimals: int = 1) -> Column:
    """``round(count * 100.0 / total, decimals)`` computed exactly."""
    return round_ratio(count, total, decimals, scale=100)


def share_exceeds(count, total, threshold) -> Column:
    """Strict test ``count * 100 / total > threshold`` without rounding.

    The threshold is taken as the exact fraction ``p / q`` of its decimal
    text, and ``count * 100 * q > p * total`` is compared as integers.
    """
    frac = Fraction(Decimal(str(threshold)))
    # Integers of scale 0 throughout: exact, and wide enough for any count.
    big = "decimal(38,0)"
    c, t = _col(count).cast(big), _col(total).cast(big)
    return c * F.lit(str(100 * frac.denominator)).cast(big) > F.lit(str(frac.numerator)).cast(big) * t
