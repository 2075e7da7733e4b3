"""Cohort retention and dormancy (M-24 ... M-28)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.functions import pct1
from uptake.operators.activity import trailing_active_by_week
from uptake.operators.common import (
    Segment, active_days, counted_in_window, day_weeks, last_event_date, not_null, seg_list,
    user_day_activity, week_ends,
)
from uptake.operators.population import activation_users, eligible_users
from uptake.tables import Tables


def user_active_weeks(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per active user: cohort_week (first active week) and the set of
    active weeks. collect_set is merged map-side and bounded by the number of
    calendar weeks, so a hot user stays one small row."""
    days = active_days(t, cfg).join(day_weeks(t), "date")
    return days.groupBy("user_id").agg(F.collect_set("week_number").alias("weeks")).select(
        "user_id", F.array_min("weeks").alias("cohort_week"), "weeks"
    )


def retention_cohorts(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Cohort = week of first meaningful action; active users and retention %
    for weeks 0..max after it. Empty cells have no row."""
    u = user_active_weeks(t, cfg)
    sizes = u.groupBy("cohort_week").agg(F.count(F.lit(1)).alias("cohort_users"))
    cells = (
        u.select("cohort_week", F.explode(F.transform("weeks", lambda w: w - F.col("cohort_week")))
                 .alias("weeks_since_activation"))
        .where(F.col("weeks_since_activation").between(0, cfg.retention_max_weeks))
        .groupBy("cohort_week", "weeks_since_activation")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    return cells.join(sizes, "cohort_week").select(
        "cohort_week", "cohort_users", "weeks_since_activation", "active_users",
        pct1("active_users", "cohort_users").alias("retention_rate_pct"),
    )


def activation_week(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per user: first meaningful event and the calendar week it falls in."""
    first = active_days(t, cfg).groupBy("user_id").agg(F.min("first_meaningful_ts").alias("first_meaningful_ts"))
    return first.withColumn("date", F.to_date("first_meaningful_ts")).join(day_weeks(t), "date", "left").select(
        "user_id", "first_meaningful_ts", F.col("week_number").alias("activation_week")
    )


def retention_grid(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Dense cohort x weeks-since grid (0..max), zero-filled."""
    r = retention_cohorts(t, cfg)
    sizes = r.select("cohort_week", "cohort_users").distinct()
    grid = sizes.select("cohort_week", "cohort_users",
                        F.explode(F.sequence(F.lit(0), F.lit(cfg.retention_max_weeks))).alias("weeks_since_activation"))
    return grid.join(r.drop("cohort_users"), ["cohort_week", "weeks_since_activation"], "left").select(
        "cohort_week", "cohort_users", "weeks_since_activation",
        F.coalesce("active_users", F.lit(0)).cast("long").alias("active_users"),
        F.coalesce("retention_rate_pct", F.lit(0.0)).alias("retention_rate_pct"),
    )


def retention_matrix(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Heatmap form: one row per cohort, columns week_0 ... week_N (%)."""
    g = retention_grid(t, cfg).withColumn("wk", F.concat(F.lit("week_"), F.col("weeks_since_activation").cast("string")))
    names = [f"week_{i}" for i in range(cfg.retention_max_weeks + 1)]
    return g.groupBy("cohort_week", "cohort_users").pivot("wk", names).agg(F.first("retention_rate_pct"))


def retention_w1_w4(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    g = retention_grid(t, cfg)
    return g.groupBy("cohort_week", "cohort_users").agg(
        F.max(F.when(F.col("weeks_since_activation") == 1, F.col("retention_rate_pct"))).alias("week1_retention_pct"),
        F.max(F.when(F.col("weeks_since_activation") == 4, F.col("retention_rate_pct"))).alias("week4_retention_pct"),
    )


def dormant_users(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = "business_unit",
                  activation: DataFrame | None = None) -> DataFrame:
    """Activated users with no meaningful action in the N dates up to the
    as-of date (default: last event date over all events).

    Recency comes from the activation frame's ``last_active_date`` (same
    per-user summary), so dormancy adds no second pass over the events.
    """
    cols = seg_list(segment)
    as_of = last_event_date(t, cfg)
    act = activation if activation is not None else activation_users(t, cfg)
    recent = F.coalesce(F.col("last_active_date") > F.date_sub(as_of, cfg.trailing_window_days), F.lit(False))
    return (
        act.where(F.col("activated") & not_null(cols))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("activated_users"), F.count_if(~recent).alias("dormant_users"))
        .withColumn("dormancy_rate_pct", pct1("dormant_users", "activated_users"))
    )


def dormancy_trend(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """Dormancy as of every week end: activated users minus those active in
    the trailing window ending that day. Counts are combined per segment, so
    no user x week grid is ever materialised.

    One pass over the events: the user-day summary is joined to the eligible
    users, the activation decision is a window over each user's day rows (at
    most one row per day, so bounded even for a hot user; the window reuses
    the join's user partitioning), and both the activated base and the
    trailing activity are read from that one frame.
    """
    cols = seg_list(segment)
    el = eligible_users(t).where(not_null(cols)).select(
        "user_id", "assigned_access_date", "training_completed_date", *cols)
    u = Window.partitionBy("user_id")
    met = F.col("training_completed_date").isNotNull() | (F.sum("n_qualifying").over(u) > 0)
    activated = met & (F.sum(counted_in_window(cfg)).over(u) >= cfg.activation_min_actions)
    days = user_day_activity(t, cfg).join(el, "user_id").withColumn("_activated", activated).where("_activated")
    base = days.groupBy(*cols).agg(F.count_distinct("user_id").alias("activated_users"))
    active = (
        trailing_active_by_week(t, cfg, days=days.where(F.col("n_meaningful") > 0).select("user_id", "date", *cols),
                                keep=cols)
        .groupBy("week_number", *cols).agg(F.count(F.lit(1)).alias("active_activated"))
    )
    weeks = week_ends(t).agg(
        F.array_sort(F.collect_list(F.struct("week_number", "week_end_date"))).alias("w")
    ).scalar()
    grid = base.select(*cols, "activated_users", F.inline(weeks))
    return grid.join(active, ["week_number", *cols], "left").select(
        "week_number", F.col("week_end_date").alias("as_of_date"), *cols, "activated_users",
        (F.col("activated_users") - F.coalesce("active_activated", F.lit(0))).alias("dormant_users"),
    ).withColumn("dormancy_rate_pct", pct1("dormant_users", "activated_users"))
