"""Strict, never-raising parsers for raw string columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from uptake.config import DATE_FORMAT, TIMESTAMP_FORMAT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_date(c, fmt: str = DATE_FORMAT) -> Column:
    """Parse with an exact pattern; anything else (incl. '2026-1-5') is null."""
    return F.call_function("try_to_date", _col(c), F.lit(fmt))


def safe_timestamp(c, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Exact-pattern timestamp parse to TIMESTAMP_NTZ (wall clock, no zone)."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def safe_double(c) -> Column:
    """Numeric coercion; unparseable and NaN/inf become null."""
    x = _col(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def safe_decimal(c, precision: int = 18, scale: int = 6) -> Column:
    """Exact decimal of a numeral, six decimals by default (a long inside Spark); what is no finite number is null.

    Plain numerals are read as decimals, so no digit passes through a binary double; other forms ('1e3') do.
    """
    kind = f"decimal({precision},{scale})"
    text = _col(c).cast("string")
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+(\.[0-9]*)?\s*$"), text.try_cast(kind)).otherwise(safe_double(c).try_cast(kind))


def safe_int(c) -> Column:
    """Nullable integer: '3' and '3.0' parse, '3.5' and junk become null."""
    x = safe_double(c)
    return F.when(x == F.floor(x), x.try_cast("int"))
