"""Date keys and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """YYYYMMDD integer key of a date or timestamp."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def week_start(c) -> Column:
    """Monday of the ISO week containing the date/timestamp, as DATE."""
    return F.date_trunc("week", _col(c)).cast("date")


def hours_between(start, end) -> Column:
    """Fractional hours end - start (works on TIMESTAMP_NTZ and DATE)."""
    s = _col(start).cast("timestamp_ntz")
    e = _col(end).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", s, e).cast("double") / F.lit(3.6e9)
