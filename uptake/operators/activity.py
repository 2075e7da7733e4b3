"""Active users and stickiness (M-08 ... M-15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.functions import pct1
from uptake.operators.common import (
    Segment, active_days, bounded_broadcast, last_event_date, seg_list, user_segment, user_weeks, week_ends,
)
from uptake.tables import Tables


def weekly_active_users(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """Distinct users with >= 1 meaningful action per calendar week [x segment].

    Events outside the calendar have no week and are dropped. With a segment,
    the user x week rows (already distinct) are joined to the users table and
    counted, so no second distinct is needed.
    """
    cols = seg_list(segment)
    uw = user_weeks(t, cfg)
    if cols:
        uw = uw.join(user_segment(t, cols), "user_id")
    return uw.groupBy("week_number", "week_start_date", *cols).agg(F.count(F.lit(1)).alias("weekly_active_users"))


def active_user_days(t: Tables, cfg: AdoptionConfig) -> DataFrame:
    """Distinct (user_id, date) with a meaningful event: the trailing-window input."""
    return active_days(t, cfg).select("user_id", "date")


def mau_trailing(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Distinct users active in the N dates ending at the as-of date (inclusive)."""
    as_of = last_event_date(t, cfg)
    n = cfg.trailing_window_days
    d = F.col("date")
    days = active_user_days(t, cfg).where((d > F.date_sub(as_of, n)) & (d <= as_of))
    return days.agg(F.count_distinct("user_id").alias("monthly_active_users")).select(
        as_of.alias("as_of_date"), F.lit(n).alias("trailing_days"), "monthly_active_users"
    )


def trailing_active_by_week(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, days: DataFrame | None = None,
                            keep: Sequence[str] = ()) -> DataFrame:
    """Distinct (user_id, *keep, week_number, week_end_date): user active in
    the trailing window that ends on the week's last calendar date.

    Each active user-day is expanded to the Sundays from its own to that of
    date + N - 1 (at most ceil(N/7) + 1 per day) and joined to the calendar's
    week ends e by the Sunday on or after e; of these, those with
    date <= e <= date + N - 1 stay, whatever weekday a week ends on (the last
    one ends with the calendar). This replaces a range join of every day with
    every week.
    ``days`` (default: every active user-day) are (user_id, date, *keep)
    rows; ``keep`` columns must be functionally dependent on the user.
    """
    n = cfg.trailing_window_days
    days = days if days is not None else active_user_days(t, cfg)

    def sunday(c):
        return F.date_add(F.date_trunc("week", c).cast("date"), 6)

    last = F.date_add("date", n - 1)
    cand = days.select("user_id", "date", *keep,
                       F.explode(F.sequence(sunday("date"), sunday(last), F.expr("INTERVAL 7 DAYS"))).alias("sunday"))
    we = bounded_broadcast(week_ends(t).select("week_number", "week_end_date", sunday("week_end_date").alias("sunday")), t.calendar)
    return cand.join(we, "sunday").where(F.col("week_end_date").between(F.col("date"), last)).select(
        "user_id", *keep, "week_number", "week_end_date").distinct()


def mau_by_week(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """Trailing-N-day active users as of every week end, in one job."""
    cols = seg_list(segment)
    a = trailing_active_by_week(t, cfg)
    if cols:
        a = a.join(user_segment(t, cols), "user_id")
    return a.groupBy("week_number", F.col("week_end_date").alias("as_of_date"), *cols).agg(
        F.count(F.lit(1)).alias("monthly_active_users")
    )


def stickiness(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """WAU / trailing MAU (%), per week [x segment]; MAU as of the week end,
    dates inclusive, so WAU never exceeds MAU."""
    cols = seg_list(segment)
    w = weekly_active_users(t, cfg, cols)
    m = mau_by_week(t, cfg, cols)
    return w.join(m, ["week_number", *cols]).select(
        "week_number", "week_start_date", "as_of_date", *cols, "weekly_active_users", "monthly_active_users",
        pct1("weekly_active_users", "monthly_active_users").alias("stickiness_pct"),
    )


def wau_week_over_week(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """WAU with prior week, change and change % on a dense week grid.

    Every segment gets every calendar week (0 when inactive), so LAG always
    looks at the previous calendar week, never at an older row.
    """
    cols = seg_list(segment)
    w = weekly_active_users(t, cfg, cols)
    weeks = t.calendar.agg(
        F.array_sort(F.collect_set(F.struct("week_number", "week_start_date"))).alias("weeks")
    ).scalar()
    segs = user_segment(t, cols).select(*cols).distinct() if cols else t.calendar.agg(F.count(F.lit(1)).alias("_n"))
    grid = segs.select(*cols, F.inline(weeks))
    d = grid.join(w, ["week_number", "week_start_date", *cols], "left").withColumn(
        "weekly_active_users", F.coalesce("weekly_active_users", F.lit(0)).cast("long")
    )
    win = Window.partitionBy(*cols).orderBy("week_number") if cols else Window.orderBy("week_number")
    prior = F.lag("weekly_active_users").over(win)
    return d.select(
        "week_number", "week_start_date", *cols, "weekly_active_users",
        prior.alias("prior_week_wau"),
        (F.col("weekly_active_users") - prior).alias("wau_change"),
        pct1(F.col("weekly_active_users") - prior, prior).alias("wau_change_pct"),
    )


def wau_share(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = "business_unit") -> DataFrame:
    """Each segment's WAU as a % of company WAU that week (via a join, so it
    stays right for segments where a user could sit in several values)."""
    cols = seg_list(segment)
    seg = weekly_active_users(t, cfg, cols)
    company = weekly_active_users(t, cfg).select("week_number", F.col("weekly_active_users").alias("company_wau"))
    return seg.join(company, "week_number").withColumn(
        "pct_of_company_wau", pct1("weekly_active_users", "company_wau")
    )
