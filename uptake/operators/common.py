"""Shared building blocks for the metric operators.

Scale rules followed throughout:

* Event-grain data is reduced to user-grain (or user x week / user x day)
  with a partial (map-side) aggregation *before* it meets the users table, so
  a user owning a third of all events costs one pre-aggregated row per
  partition, not a third of the join.
* Only bounded tables are broadcast: the calendar (one row per day) and the
  feature catalog, and only after their row count is checked against
  ``MAX_BROADCAST_ROWS`` (``bounded_broadcast``); past the bound they are
  joined by shuffle like everything that grows with the data, which is left
  to AQE: it converts to broadcast at runtime when the measured size allows
  and splits skewed partitions.
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig
from uptake.tables import Tables

Segment = str | Sequence[str] | None


def seg_list(segment: Segment) -> list[str]:
    if segment is None:
        return []
    if isinstance(segment, str):
        return [segment]
    return list(segment)


def not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def meaningful(events: DataFrame, cfg: AdoptionConfig) -> DataFrame:
    return events.where(F.col("event_type").isin(*cfg.meaningful_event_types))


def event_date(events: DataFrame) -> Column:
    """The date of an event: the partition column of the clean layer where the table has it, else from the timestamp.

    Filters and maxima on the partition column prune folders and read no event column."""
    return F.col("event_date") if "event_date" in events.columns else F.to_date("event_timestamp")


# Explicit broadcast hints only for tables checked to have at most this many
# rows (a calendar of 100k days spans ~270 years; the feature catalog is a
# fixed list). Rows here are a few narrow columns, so the bound is a few MB.
MAX_BROADCAST_ROWS = 100_000
_FITS: "weakref.WeakKeyDictionary[DataFrame, bool]" = weakref.WeakKeyDictionary()


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Counted once per frame
    object with ``limit(max_rows + 1)``, so a large input stops early; meant
    for the small dimension-like tables (cached calendar, literal catalog)."""
    hit = _FITS.get(df)
    if hit is None:
        hit = _FITS[df] = df.limit(max_rows + 1).count() <= max_rows
    return hit


def bounded_broadcast(df: DataFrame, source: DataFrame | None = None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when ``source`` (default ``df``; the table ``df`` is a
    projection or aggregate of) passes the row-count check, else ``df`` as is:
    a shuffle join that AQE may still turn into a broadcast from measured sizes."""
    return F.broadcast(df) if fits_broadcast(source if source is not None else df, max_rows) else df


MAX_PIVOT_VALUES = 1000


def pivot_values(df: DataFrame, column: str, listed: list[str]) -> list[str]:
    """Columns of a pivot: the listed values, then all others present, so that no row is lost.

    The columns of a result must be known to plan it, so the different values are fetched: at most ``MAX_PIVOT_VALUES``,
    and more are an error rather than a lost column or a result too wide to read.
    """
    present = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).distinct().orderBy(column).limit(MAX_PIVOT_VALUES + 1).collect()
    if len(present) > MAX_PIVOT_VALUES:
        raise ValueError(f"{column} has more than {MAX_PIVOT_VALUES} values: too many for columns")
    return [*listed, *(r[0] for r in present if r[0] not in listed)]


def day_weeks(t: Tables) -> DataFrame:
    """date -> (week_number, week_start_date); one row per day, broadcast
    after the size check."""
    return bounded_broadcast(t.calendar.select("date", "week_number", "week_start_date"), t.calendar)


def week_ends(t: Tables) -> DataFrame:
    """One row per calendar week: week_number, week_start_date, week_end_date."""
    return t.calendar.groupBy("week_number").agg(
        F.min("week_start_date").alias("week_start_date"), F.max("date").alias("week_end_date")
    )


def user_day_rows(events: DataFrame, cfg: AdoptionConfig) -> DataFrame:
    """One row per (user_id, date) with any event: the event summary, merged map-side."""
    ts = F.col("event_timestamp")
    d = event_date(events)
    m = F.col("event_type").isin(*cfg.meaningful_event_types)
    q = F.coalesce(F.col("feature_name") == cfg.qualifying_feature, F.lit(False))
    value_ok = F.col("event_type").isin(*cfg.value_event_types) & F.coalesce("successful_completion_flag", F.lit(False))
    # Events without a date cannot be placed in time (cleaning quarantines
    # them). Stating the filter here, rather than leaving Catalyst to infer it
    # from a calendar join in some branches only, keeps every branch's
    # summary sub-plan identical, so exchange reuse runs it once.
    return events.where(d.isNotNull() & F.col("user_id").isNotNull()).groupBy("user_id", d.alias("date")).agg(
        F.count_if(m).alias("n_meaningful"),
        F.count_if(m & (ts == d.cast("timestamp_ntz"))).alias("n_meaningful_midnight"),
        F.count_if(q).alias("n_qualifying"),
        F.count_if(m & q).alias("n_meaningful_qualifying"),
        F.sum(F.when(m, F.col("estimated_minutes_saved"))).alias("minutes_meaningful"),
        F.min(F.when(value_ok, ts)).alias("first_value_ts"),
        F.min(F.when(m, ts)).alias("first_meaningful_ts"),
        F.count(F.lit(1)).alias("n_events"),
    )


def known_users(rows: DataFrame, t: Tables) -> DataFrame:
    """D19: activity of users that the users table does not have belongs to no metric. Applied to rows that were
    aggregated per user, never to raw events."""
    return rows.join(t.users.select("user_id"), "user_id", "left_semi")


def user_day_activity(t: Tables, cfg: AdoptionConfig) -> DataFrame:
    """One row per (user_id, date) with any event of a known user: the shared event summary.

    Every user-level metric (activation, time-to-value, dormancy, WAU,
    retention, trailing windows) is derived from this one partially
    aggregated pass over the events, so a query touching several of them
    reads and shuffles the event table once (identical sub-plans are reused
    by Spark's exchange reuse), and a user owning a third of the events is
    reduced to one row per day before any shuffle.
    """
    return t.user_day if t.user_day is not None else known_users(user_day_rows(t.events, cfg), t)


def user_feature_rows(events: DataFrame, cfg: AdoptionConfig) -> DataFrame:
    """One row per (user_id, date, feature_name) with an adoption event or a successful value event with an estimate."""
    adopts = F.col("event_type").isin(*cfg.adoption_event_types)
    saves = (F.col("event_type").isin(*cfg.value_event_types) & F.coalesce("successful_completion_flag", F.lit(False))
             & F.col("estimated_minutes_saved").isNotNull())
    return events.where(F.col("feature_name").isNotNull() & F.col("user_id").isNotNull() & (adopts | saves)).groupBy(
        "user_id", event_date(events).alias("date"), "feature_name").agg(
        F.count_if(adopts).alias("n_adoptions"), F.count_if(saves).alias("n_estimates"),
        F.sum(F.when(saves, F.col("estimated_minutes_saved"))).alias("minutes"))


def user_feature_activity(t: Tables, cfg: AdoptionConfig) -> DataFrame:
    """The summary of ``user_feature_rows`` for known users: what feature adoption and time saved are derived from."""
    return t.user_feature if t.user_feature is not None else known_users(user_feature_rows(t.events, cfg), t)


def active_days(t: Tables, cfg: AdoptionConfig) -> DataFrame:
    """User-days with at least one meaningful event."""
    return user_day_activity(t, cfg).where(F.col("n_meaningful") > 0)


def precompute(t: Tables, cfg: AdoptionConfig) -> Tables:
    """Materialise the user-day summary once (in the shared checkpoint folder)
    so every report of a batch run reads it instead of the events."""
    if t.user_day_stored:
        return t
    from uptake.session import materialize
    return t.replace(user_day=materialize(user_day_activity(t, cfg), "user_day"), user_day_stored=True)


def last_event_date(t: Tables, cfg: AdoptionConfig) -> Column:
    """As-of date: the configured one, else the last event date in the data.

    A scalar subquery evaluated once: a max over the timestamp column alone,
    partially aggregated per task (one value each), no shuffle of event rows.
    """
    if cfg.as_of_date:
        return F.lit(cfg.as_of_date).cast("date")
    if t.user_day is not None:
        return t.user_day.agg(F.max("date").alias("d")).scalar()
    return t.events.agg(F.max(event_date(t.events)).alias("d")).scalar()


def counted_in_window(cfg: AdoptionConfig) -> Column:
    """Meaningful actions of one user-day summary row (joined to the user's
    ``assigned_access_date``) that fall in the activation window: the whole
    last day for boundary "date", only its midnight for "instant"."""
    d = F.col("date")
    last = F.date_add("assigned_access_date", cfg.activation_window_days)
    in_days = d >= F.col("assigned_access_date")
    if cfg.activation_boundary == "instant":
        return (F.when(in_days & (d < last), F.col("n_meaningful"))
                .when(in_days & (d == last), F.col("n_meaningful_midnight")).otherwise(0))
    return F.when(in_days & (d <= last), F.col("n_meaningful")).otherwise(0)


def user_summary(t: Tables, cfg: AdoptionConfig) -> DataFrame:
    """One row per user (in the users table) with at least one event: every
    per-user fact the user-level metrics need, from ONE aggregation.

    meaningful_action_count  meaningful actions in the activation window
    used_qualifying_feature  any event on the qualifying feature
    first_value_ts           first successful value event
    last_active_date         last date with a meaningful action, on or before
                             the configured as-of date when one is set

    The user-day summary is joined to the users' access dates on user_id and
    grouped by user_id, which reuses the join's partitioning. Computing all
    facts in one frame keeps metrics that combine them (activation +
    dormancy, scorecards) on a single pass over the events.
    """
    acc = t.users.select("user_id", "assigned_access_date")
    d = F.col("date")
    counted = counted_in_window(cfg)
    active = F.col("n_meaningful") > 0
    if cfg.as_of_date:
        active = active & (d <= F.lit(cfg.as_of_date).cast("date"))
    return user_day_activity(t, cfg).join(acc, "user_id").groupBy("user_id").agg(
        F.sum(counted).cast("long").alias("meaningful_action_count"),
        (F.sum("n_qualifying") > 0).alias("used_qualifying_feature"),
        F.min("first_value_ts").alias("first_value_ts"),
        F.max(F.when(active, d)).alias("last_active_date"),
    )


def user_segment(t: Tables, segment: Segment) -> DataFrame:
    cols = seg_list(segment)
    return t.users.select("user_id", *cols).where(not_null(cols))


def user_weeks(t: Tables, cfg: AdoptionConfig) -> DataFrame:
    """Distinct (user_id, week_number, week_start_date) with a meaningful event,
    carrying the week's meaningful-event count, minutes and qualifying-feature
    events. Built from the user-day summary; the calendar join is a broadcast
    hash join (one row per day), and the (user, week) grouping reuses the
    summary's user partitioning where the planner can."""
    return active_days(t, cfg).join(day_weeks(t), "date").groupBy("user_id", "week_number", "week_start_date").agg(
        F.sum("n_meaningful").alias("n_events"),
        F.sum("minutes_meaningful").alias("minutes"),
        F.sum("n_meaningful_qualifying").alias("n_qualifying"),
    )


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach every column of a one-row frame (an aggregate without grouping)
    to each row of ``df`` as a scalar subquery: evaluated once, no join and
    no row product. An empty ``one_row`` gives nulls, like SQL."""
    cols = one_row.columns
    s = one_row.select(F.struct(*cols).alias("_s")).scalar()
    return df.withColumn("_scalars", s).select(*[c for c in df.columns], *[F.col(f"_scalars.{c}").alias(c) for c in cols])
