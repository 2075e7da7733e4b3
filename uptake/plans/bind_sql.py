"""The test-data binding (FIXTURES.md §3) as DuckDB SQL CTEs.

Mirrors :mod:`uptake.sources.testbind` expression for expression; every
oracle query is ``WITH <BIND_CTES>, <metric ctes> SELECT ...``.
"""

from __future__ import annotations

from uptake.config import CANONICAL_FEATURES, FEATURE_CATALOG
from uptake.sources.testbind import (
    BACKGROUND_EVENT_TYPE, BARRIER_BY_PRIORITY, EVENT_TYPE_MAP, PLATFORMS, PROMPT_CATEGORIES, ROLES, SEGMENTS, SESSION_TOPICS,
    SOURCE_SYSTEMS, TRAINING_FORMATS, USAGE_CUTOFF,
)

# user-days that carry usage actions (the rest are background app_opened rows)
USAGE = (f"((e.user_id * 7 + CAST(day(e.ts) AS INTEGER) * 11) % 10 < e.user_id % 3 + 3"
         f" AND (e.user_id % 4 <> 0 OR e.ts < TIMESTAMP '{USAGE_CUTOFF}'))")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def case_pick(expr: str, values) -> str:
    whens = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"CASE CAST({expr} AS INTEGER) {whens} END"


def case_map(expr: str, mapping: dict) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} END"


def half_up_ratio(num: str, den: str, digits: int = 1) -> str:
    """SQL twin of :func:`uptake.functions.numeric.half_up_ratio`."""
    scale = 10 ** digits
    n, d = f"CAST({num} AS BIGINT)", f"CAST({den} AS BIGINT)"

    def pos(x):
        return f"(CAST((({x}) * {2 * scale} + {d}) // NULLIF({d} * 2, 0) AS DOUBLE) / {float(scale)})"

    return f"(CASE WHEN {n} < 0 THEN -{pos('-' + n)} ELSE {pos(n)} END)"


def pct1(num: str, den: str) -> str:
    return half_up_ratio(f"CAST({num} AS BIGINT) * 100", den, 1)


def date_plus(base: str, offset: str) -> str:
    return f"(DATE {q(base)} + CAST({offset} AS INTEGER))"


_FEATURE_VALUES = ",\n        ".join(
    f"({q(fid)}, {q(name)}, {q(cat)}, {q(persona)}, DATE {q(rel)}, {str(core).upper()})"
    for fid, name, cat, persona, rel, core in FEATURE_CATALOG
)

BIND_CTES = f"""
users AS (
    SELECT
        c.c_custkey AS user_id,
        c.c_mktsegment AS business_unit,
        {case_pick('c.c_custkey % 4', ROLES)} AS role,
        g.r_name AS region,
        CASE WHEN c.c_custkey % 4 = 2 THEN 'People Manager' ELSE 'Individual Contributor' END AS manager_level,
        {date_plus('2018-01-01', 'c.c_custkey % 2000')} AS hire_date,
        CASE WHEN c.c_custkey % 41 <> 7 THEN {date_plus('2024-01-01', 'c.c_custkey % 21')} END AS assigned_access_date,
        CAST(c.c_custkey % 6 + 1 AS INTEGER) AS rollout_wave,
        CASE WHEN c.c_custkey % 23 <> 5 THEN {date_plus('2023-12-28', 'c.c_custkey % 21')} END AS training_assigned_date,
        CASE WHEN c.c_custkey % 3 <> 0 AND c.c_custkey % 23 <> 5
             THEN {date_plus('2023-12-31', 'c.c_custkey % 21 + c.c_custkey % 19')} END AS training_completed_date,
        {case_pick('c.c_custkey % 3', TRAINING_FORMATS)} AS training_format,
        CASE WHEN c.c_custkey % 97 <> 3 THEN c.c_custkey % 5 = 0 END AS manager_champion_flag,
        c.c_custkey % 19 <> 4 AS eligible_for_access_flag
    FROM customer c
    LEFT JOIN (SELECT n.n_nationkey, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
      ON c.c_nationkey = g.n_nationkey
),
usage_events AS (
    SELECT
        e.event_id,
        e.user_id,
        e.ts AS event_timestamp,
        concat_ws('-', 'S', CAST(e.user_id AS VARCHAR), strftime(e.ts, '%Y%m%d')) AS session_id,
        CASE WHEN {USAGE} AND TRY_CAST(regexp_extract(e.props, '([0-9]+)', 1) AS INTEGER) % 9 < 8
             THEN {case_pick("TRY_CAST(regexp_extract(e.props, '([0-9]+)', 1) AS INTEGER) % 9", CANONICAL_FEATURES)}
        END AS feature_name,
        CASE WHEN {USAGE} THEN
             COALESCE({case_map('e.event_type', EVENT_TYPE_MAP)},
                      CASE WHEN e.event_type = 'purchase' THEN
                           CASE WHEN e.event_id % 4 = 0 THEN 'output_exported' ELSE 'feature_completed' END END,
                      e.event_type)
             ELSE {q(BACKGROUND_EVENT_TYPE)} END AS event_type,
        CASE WHEN e.event_id % 11 <> 3 THEN {case_pick('e.event_id % 4', PROMPT_CATEGORIES)} END AS prompt_category,
        ({USAGE} AND e.event_type = 'purchase' AND e.event_id % 4 = 0) AS output_exported_flag,
        (e.event_type <> 'error' AND e.event_id % 14 <> 0) AS successful_completion_flag,
        CASE WHEN {USAGE} AND e.event_type IN ('click', 'purchase') AND e.event_id % 14 <> 0
             THEN CAST(e.value AS DECIMAL(18,2)) END AS estimated_minutes_saved,
        CAST(e.event_id % 600 + 5 AS INTEGER) AS session_duration_seconds,
        ({USAGE} AND e.event_type = 'error') AS error_flag,
        {case_pick('e.event_id % 3', PLATFORMS)} AS platform,
        {case_pick('e.event_id % 3', SOURCE_SYSTEMS)} AS source_system
    FROM events e
    LEFT JOIN users u ON u.user_id = e.user_id
    WHERE u.assigned_access_date IS NULL OR CAST(e.ts AS DATE) >= u.assigned_access_date
),
feedback AS (
    SELECT
        o.o_orderkey AS feedback_id,
        o.o_custkey AS user_id,
        CAST({date_plus('2024-01-01', 'o.o_orderkey % 30')} AS TIMESTAMP)
            + to_hours(CAST(o.o_orderkey % 24 AS INTEGER)) AS feedback_timestamp,
        CASE WHEN o.o_orderkey % 97 <> 0 THEN CAST(o.o_orderkey % 5 + 1 AS INTEGER) END AS rating_1_to_5,
        CASE WHEN o.o_orderkey % 97 <> 0 AND o.o_orderkey % 5 + 1 >= 4 THEN 'Positive'
             WHEN o.o_orderkey % 97 <> 0 AND o.o_orderkey % 5 + 1 <= 2 THEN 'Negative'
             ELSE 'Neutral' END AS sentiment_label,
        {case_map('o.o_orderpriority', BARRIER_BY_PRIORITY)} AS barrier_category,
        CASE WHEN o.o_orderkey % 13 <> 0 THEN 'Order feedback, status ' || o.o_orderstatus END AS free_text_feedback,
        CASE WHEN o.o_orderkey % 10 < 8 THEN {case_pick('o.o_orderkey % 10', CANONICAL_FEATURES)} END AS feature_name,
        CASE o.o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS would_recommend_flag
    FROM orders o
),
calendar AS (
    SELECT
        CAST(d.dt AS DATE) AS date,
        CAST(b.s + CAST(date_diff('day', b.s, CAST(d.dt AS DATE)) // 7 * 7 AS INTEGER) AS DATE) AS week_start_date,
        CAST(date_diff('day', b.s, CAST(d.dt AS DATE)) // 7 + 1 AS INTEGER) AS week_number,
        CAST(month(d.dt) AS INTEGER) AS month,
        monthname(d.dt) AS month_name,
        CAST(quarter(d.dt) AS INTEGER) AS quarter,
        CAST(year(d.dt) AS INTEGER) AS year
    FROM (SELECT CAST(date_trunc('week', min(ts)) AS DATE) AS s,
                 CAST(date_trunc('week', max(ts)) AS DATE) + 6 AS e FROM events) b,
         LATERAL (SELECT unnest(generate_series(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY)) AS dt) d
),
feature_catalog AS (
    SELECT * FROM (VALUES
        {_FEATURE_VALUES}
    ) AS t(feature_id, feature_name, feature_category, target_persona, release_date, core_feature_flag)
),
training_sessions AS (
    SELECT
        s.s_suppkey AS training_session_id,
        {date_plus('2024-01-01', 's.s_suppkey % 30')} AS session_date,
        {case_pick('s.s_suppkey % 5', SEGMENTS)} AS business_unit,
        {case_pick('s.s_suppkey % 3', TRAINING_FORMATS)} AS training_format,
        CAST(s.s_suppkey % 100 + 20 AS INTEGER) AS registered_count,
        CAST(CASE WHEN s.s_suppkey % 50 = 9 THEN s.s_suppkey % 100 + 22
                  ELSE (s.s_suppkey % 100 + 20) * 3 // 4 END AS INTEGER) AS attended_count,
        CAST(CASE WHEN s.s_suppkey % 50 = 9 THEN s.s_suppkey % 100 + 23
                  ELSE ((s.s_suppkey % 100 + 20) * 3 // 4) * 4 // 5 END AS INTEGER) AS completion_count,
        s.s_name AS facilitator,
        {case_pick('s.s_suppkey % 4', SESSION_TOPICS)} AS session_topic
    FROM supplier s
)"""


def with_bind(body: str, extra_ctes: str = "") -> str:
    """Full oracle statement: binding CTEs, optional metric CTEs, final SELECT."""
    sep = ",\n" if extra_ctes.strip() else ""
    return f"WITH {BIND_CTES}{sep}{extra_ctes}\n{body}"
