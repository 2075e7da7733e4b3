"""Label and flag normalisation as native expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from uptake.config import FALSE_TOKENS, TRUE_TOKENS


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Without white space (tabs and line ends too) at both ends."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def is_blank(c) -> Column:
    c = _col(c)
    return c.isNull() | (strip(c) == "")


def blank_to_null(c) -> Column:
    c = _col(c)
    return F.when(strip(c) != "", c)


def normalize_label(c, canonical: Iterable[str], variants: Mapping[str, str]) -> Column:
    """Map a free-text label to its canonical spelling.

    null/blank stay as they are; otherwise the trimmed lower-case key is looked
    up in the variant map, then matched case-insensitively against the
    canonical list; anything unmatched is returned trimmed, unchanged.
    """
    c = _col(c)
    lookup: dict[str, str] = {v.lower(): v for v in canonical}
    lookup.update({k: v for k, v in variants.items()})  # variant map wins
    kv = []
    for k in sorted(lookup):
        kv += [F.lit(k), F.lit(lookup[k])]
    mapping = F.create_map(*kv)
    key = F.lower(strip(c))
    return F.when(is_blank(c), c).otherwise(F.coalesce(F.try_element_at(mapping, key), strip(c)))


def to_bool(c) -> Column:
    """true/1/yes -> True, false/0/no -> False (any case, trimmed), else null.

    Deliberately not ``try_cast(... as boolean)``, which also accepts t/f/y/n.
    """
    key = F.lower(strip(_col(c).cast("string")))
    return (
        F.when(key.isin(*TRUE_TOKENS), F.lit(True))
        .when(key.isin(*FALSE_TOKENS), F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )
