"""Data checks re-aimed from the reference's test suite (E-1 ... E-7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.config import ALL_EVENT_TYPES, AdoptionConfig, DEFAULT_CONFIG
from uptake.operators import feedback, population, retention
from uptake.operators.activity import weekly_active_users
from uptake.operators.common import known_users, user_day_rows
from uptake.session import materialize
from uptake.tables import Tables


def required_columns(df: DataFrame, required) -> list[str]:
    """E-1: missing column names (schema only, no job)."""
    return [c for c in required if c not in df.columns]


def _fused(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule from one aggregate that counts the failures of all of them."""
    counts = df.agg(*[c.cast("long").alias(f"n{i}") for i, c in enumerate(rules.values())])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(f"n{i}").alias("failures"), (F.col(f"n{i}") == 0).alias("passed"))
        for i, name in enumerate(rules)])))


# E-2 default: every table has at least one row (bounds are inclusive; None = unbounded)
DEFAULT_ROW_BOUNDS = {name: (1, None) for name in
                      ("users", "events", "feedback", "calendar", "features", "training")}


def rows_outside(bounds: tuple[int | None, int | None]) -> Column:
    """Aggregate: 1 failure when the table's row count is outside [lo, hi]."""
    lo, hi = bounds
    n = F.count(F.lit(1))
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (n >= lo)
    if hi is not None:
        ok = ok & (n <= hi)
    return F.when(ok, 0).otherwise(1)


def row_count_failures(df: DataFrame, bounds: tuple[int | None, int | None]) -> DataFrame:
    """E-2 for one table: a row ``(failures)``, one partial count per task."""
    return df.agg(rows_outside(bounds).alias("failures"))


def values_outside(df: DataFrame, col: str, allowed) -> DataFrame:
    """E-4 for one column: non-null values outside the canonical set, a row ``(failures)``."""
    c = F.col(col)
    return df.agg(F.count_if(c.isNotNull() & ~c.isin(*allowed)).alias("failures"))


def expectations_report(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG,
                        row_bounds: dict[str, tuple[int | None, int | None]] | None = None) -> DataFrame:
    """One row per invariant with its number of violating rows.

    E-2 row counts per table (``row_bounds``: table -> (min, max)), E-3 unique
    keys, E-4 canonical value sets (null allowed), E-5 numeric bounds, E-6
    cross-table date order, E-7 metric invariants. The events are read three
    times: for the rules on their rows, for their keys, and for the user-day
    summary, written once, that all metric invariants read.
    """
    bounds = DEFAULT_ROW_BOUNDS if row_bounds is None else row_bounds
    frames = {"users": t.users, "events": t.events, "feedback": t.feedback, "calendar": t.calendar,
              "features": t.features, "training": t.training}
    # per (user, day) counts first: the users join then sees user-day rows, not raw events
    days = materialize(user_day_rows(t.events, cfg), "user_day")
    t = t.replace(user_day=known_users(days, t), user_day_stored=True)
    ev = days.select("user_id", "date", "n_events").join(t.users.select("user_id", "assigned_access_date"), "user_id", "left")
    act = population.activation_rate(t, cfg, "business_unit")
    ret = retention.retention_cohorts(t, cfg)
    ranks = feedback.barrier_ranking(t, cfg)
    wau = weekly_active_users(t, cfg)
    zero = F.lit(0).cast("long")

    def outside(c: str, allowed) -> Column:
        return F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*allowed))

    # rules on the rows of one table are aggregates of one pass over it
    row_rules = {
        "users": {"business_unit in canonical set": outside("business_unit", cfg.canonical_business_units)},
        "events": {
            "no negative minutes or duration": F.count_if((F.col("estimated_minutes_saved") < 0) | (F.col("session_duration_seconds") < 0)),
            "event_type in canonical set": outside("event_type", ALL_EVENT_TYPES),
            "event feature_name in canonical set": outside("feature_name", cfg.feature_names),
        },
        "feedback": {
            "ratings within 1-5": F.count_if(~F.col("rating_1_to_5").between(1, 5)),
            "feedback feature_name in canonical set": outside("feature_name", cfg.feature_names),
            "barrier_category in canonical set": outside("barrier_category", cfg.barrier_categories),
        },
    }
    for name, bound in bounds.items():
        row_rules.setdefault(name, {})[f"{name} row count in range"] = rows_outside(bound)
    act_rules = {
        "activated <= eligible": F.count_if(F.col("activated_users") > F.col("eligible_users")),
        "activation rate within 0-100": F.count_if(~F.col("activation_rate_pct").between(0, 100)),
    }
    checks = [_fused(frames[name], rules) for name, rules in row_rules.items()] + [
        _fused(act, act_rules),
        _fused(t.users.groupBy("user_id").count(), {"unique user_id": F.count_if(F.col("count") > 1)}),
        _fused(t.events.groupBy("event_id").count(), {"unique event_id": F.count_if(F.col("count") > 1)}),
        _fused(ev, {"no event before access date": F.coalesce(
            F.sum(F.when(F.col("date") < F.col("assigned_access_date"), F.col("n_events"))), zero)}),
        _fused(ret.where("weeks_since_activation = 0"), {"week-0 retention is 100": F.count_if(F.col("retention_rate_pct") != 100.0)}),
        _fused(ranks.groupBy("business_unit").agg(F.min("barrier_rank").alias("m")), {"barrier ranks start at 1": F.count_if(F.col("m") != 1)}),
        _fused(t.calendar.select("week_number").distinct().join(wau, "week_number", "left_anti"),
               {"every calendar week has WAU": F.count(F.lit(1))}),
    ]
    return reduce(DataFrame.unionByName, checks)


def null_segment_counts(t: Tables, segments) -> DataFrame:
    """D18: segment metrics drop users whose segment value is null; report how
    many users and events that removes, per segment column. Events are
    pre-counted per user before meeting the users table."""
    per_user = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    u = t.users.join(per_user, "user_id", "left")
    parts = [
        u.agg(F.count_if(F.col(c).isNull()).alias("users_dropped"),
              F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("n"))), F.lit(0)).cast("long").alias("events_dropped"))
        .select(F.lit(c).alias("segment_column"), "users_dropped", "events_dropped")
        for c in segments
    ]
    return reduce(DataFrame.unionByName, parts)
