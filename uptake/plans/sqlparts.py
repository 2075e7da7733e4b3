"""Reusable SQL CTE text for the oracle statements (DuckDB dialect)."""

from __future__ import annotations

from uptake.config import AdoptionConfig
from uptake.plans.bind_sql import q


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def meaningful(cfg: AdoptionConfig) -> str:
    return f"event_type IN {in_list(cfg.meaningful_event_types)}"


def activation_ctes(cfg: AdoptionConfig) -> str:
    n, k = cfg.activation_window_days, cfg.activation_min_actions
    return f"""
eligible AS (
    SELECT * FROM users
    WHERE COALESCE(eligible_for_access_flag, FALSE) AND assigned_access_date IS NOT NULL
),
actions AS (
    SELECT e.user_id, COUNT(*) AS meaningful_action_count
    FROM usage_events f JOIN eligible e ON e.user_id = f.user_id
    WHERE f.{meaningful(cfg)}
      AND CAST(f.event_timestamp AS DATE) >= e.assigned_access_date
      AND CAST(f.event_timestamp AS DATE) <= e.assigned_access_date + {n}
    GROUP BY e.user_id
),
qual AS (SELECT DISTINCT user_id FROM usage_events WHERE feature_name = {q(cfg.qualifying_feature)}),
activation AS (
    SELECT e.*,
           CAST(COALESCE(a.meaningful_action_count, 0) AS BIGINT) AS meaningful_action_count,
           q.user_id IS NOT NULL AS used_qualifying_feature,
           e.training_completed_date IS NOT NULL AS completed_training,
           (e.training_completed_date IS NOT NULL OR q.user_id IS NOT NULL) AS met_qualification_condition,
           (e.training_completed_date IS NOT NULL OR q.user_id IS NOT NULL)
               AND COALESCE(a.meaningful_action_count, 0) >= {k} AS activated
    FROM eligible e
    LEFT JOIN qual q ON q.user_id = e.user_id
    LEFT JOIN actions a ON a.user_id = e.user_id
)"""


def user_weeks(cfg: AdoptionConfig) -> str:
    return f"""
uw AS (
    SELECT f.user_id, c.week_number, c.week_start_date
    FROM usage_events f JOIN calendar c ON c.date = CAST(f.event_timestamp AS DATE)
    WHERE f.{meaningful(cfg)}
    GROUP BY f.user_id, c.week_number, c.week_start_date
)"""


def as_of(cfg: AdoptionConfig) -> str:
    if cfg.as_of_date:
        return f"(DATE {q(cfg.as_of_date)})"
    return "(SELECT MAX(CAST(event_timestamp AS DATE)) FROM usage_events)"


def week_ends() -> str:
    return """
we AS (
    SELECT week_number, MIN(week_start_date) AS week_start_date, MAX(date) AS week_end_date
    FROM calendar GROUP BY week_number
)"""


def trailing_active(cfg: AdoptionConfig) -> str:
    """Distinct (user, week) active in the N dates ending at each week end."""
    n = cfg.trailing_window_days
    return f"""
active_days AS (
    SELECT DISTINCT user_id, CAST(event_timestamp AS DATE) AS date FROM usage_events WHERE {meaningful(cfg)}
),
{week_ends().strip()},
tw AS (
    SELECT DISTINCT a.user_id, w.week_number, w.week_end_date
    FROM active_days a JOIN we w ON a.date <= w.week_end_date AND a.date > w.week_end_date - {n}
)"""
