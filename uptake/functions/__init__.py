"""Column-expression helpers (all JVM-side built-ins; no Python UDFs)."""

from uptake.functions.numeric import half_up_decimal, half_up_ratio, pct1, safe_ratio, idiv
from uptake.functions.labels import normalize_label, to_bool, blank_to_null, is_blank, strip
from uptake.functions.parsing import safe_date, safe_timestamp, safe_double, safe_decimal, safe_int
from uptake.functions.dates import date_key, hours_between, week_start

__all__ = [
    "half_up_decimal", "half_up_ratio", "pct1", "safe_ratio", "idiv",
    "normalize_label", "to_bool", "blank_to_null", "is_blank", "strip",
    "safe_date", "safe_timestamp", "safe_double", "safe_decimal", "safe_int",
    "date_key", "hours_between", "week_start",
]
