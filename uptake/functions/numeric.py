"""Exact ratios and percentages.

Rates are rounded half away from zero (the SQL NUMERIC rule) using integer
arithmetic only, so the answer does not depend on float summation order or on
an engine's rounding of binary doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(num, den) -> Column:
    """Exact integer floor division of non-negative longs (null if den is 0/null)."""
    n, d = _col(num).cast("long"), F.nullif(_col(den).cast("long"), F.lit(0))
    return F.call_function("div", n, d)


def half_up_ratio(num, den, digits: int = 1) -> Column:
    """round(num / den, digits), half away from zero, as DOUBLE; null when den is 0.

    num and den are integers (counts, cents); den must be positive.
    """
    n, d = _col(num).cast("long"), _col(den).cast("long")
    scale = 10 ** digits

    def pos(x):
        return idiv(x * (2 * scale) + d, d * 2).cast("double") / F.lit(float(scale))

    return F.when(n < 0, -pos(-n)).otherwise(pos(n))


def half_up_decimal(num, den, digits: int = 1) -> Column:
    """``half_up_ratio`` of a decimal (a sum of minutes) by an integer: exact at any scale and beyond the range of longs."""
    n, d = _col(num), F.nullif(_col(den).cast("long"), F.lit(0))
    scale = 10 ** digits

    def pos(x):
        return F.call_function("div", x * (2 * scale) + d, d * 2).cast("double") / F.lit(float(scale))

    return F.when(n < 0, -pos(-n)).otherwise(pos(n))


def pct1(num, den) -> Column:
    """Percentage with one decimal: round(100 * num / den, 1)."""
    return half_up_ratio(_col(num).cast("long") * 100, den, 1)


def safe_ratio(num, den) -> Column:
    """num / den as double, null when den is 0 (never raises under ANSI)."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
