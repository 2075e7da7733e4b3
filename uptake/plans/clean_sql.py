"""DuckDB SQL twins of the dirty projection and the cleaning pipelines."""

from __future__ import annotations

from uptake.config import CANONICAL_FEATURES, AdoptionConfig
from uptake.plans.bind_sql import case_pick, q
from uptake.sources.dirty import BAD_DATES, BAD_TIMESTAMPS, FALSE_SPELLINGS, TRUE_SPELLINGS

D = "'%Y-%m-%d'"
TS = "'%Y-%m-%d %H:%M:%S'"


def spell_bool(b: str, k: str) -> str:
    return (f"CASE WHEN {b} IS NULL THEN NULL WHEN {k} % 89 = 5 THEN 't' WHEN {k} % 89 = 6 THEN '' "
            f"WHEN {b} THEN {case_pick(k + ' % 4', TRUE_SPELLINGS)} ELSE {case_pick(k + ' % 4', FALSE_SPELLINGS)} END")


def label_dirt(f: str, k: str, blank_mod: int = 503) -> str:
    return (f"CASE WHEN {f} IS NULL THEN {f} WHEN {k} % {blank_mod} = 6 THEN '' WHEN {k} % 53 = 7 THEN lower({f}) "
            f"WHEN {k} % 53 = 8 THEN {f} || ' ' WHEN {k} % 53 = 9 THEN replace({f}, ' and ', ' & ') "
            f"WHEN {k} % 53 = 10 AND {f} = 'Document Summarization' THEN 'Doc Summarization' ELSE {f} END")


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g')"


def to_bool(x: str) -> str:
    k = f"lower({strip(f'CAST({x} AS VARCHAR)')})"
    return f"(CASE WHEN {k} IN ('true', '1', 'yes') THEN TRUE WHEN {k} IN ('false', '0', 'no') THEN FALSE END)"


def normalize(x: str, canonical, variants: dict) -> str:
    lookup = {v.lower(): v for v in canonical}
    lookup.update(variants)
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in sorted(lookup.items()))
    return f"(CASE WHEN {x} IS NULL OR {strip(x)} = '' THEN {x} ELSE COALESCE(CASE lower({strip(x)}) {whens} END, {strip(x)}) END)"


def blank_null(x: str) -> str:
    return f"(CASE WHEN {strip(x)} <> '' THEN {x} END)"


def is_blank(x: str) -> str:
    return f"({x} IS NULL OR {strip(x)} = '')"


def sdate(x: str) -> str:
    return f"CAST(try_strptime({x}, {D}) AS DATE)"


def sts(x: str) -> str:
    return f"try_strptime({x}, {TS})"


def sdouble(x: str) -> str:
    v = f"TRY_CAST({x} AS DOUBLE)"
    return f"(CASE WHEN isnan({v}) OR isinf({v}) THEN NULL ELSE {v} END)"


def sint(x: str) -> str:
    v = sdouble(x)
    return f"(CASE WHEN {v} = floor({v}) THEN TRY_CAST({v} AS INTEGER) END)"


def smin(x: str) -> str:
    """Minutes: the numeral itself, six decimals."""
    return f"TRY_CAST({x} AS DECIMAL(18,6))"


def not_in(x: str, values) -> str:
    return f"NOT COALESCE({x} IN ({', '.join(q(v) for v in values)}), FALSE)"


FEATURES = f"""raw_features AS (
    SELECT ' P' || lpad(CAST(k AS VARCHAR), 2, '0') AS feature_id,
        CASE WHEN k = 9 THEN brand WHEN k < 8 THEN ' ' || {case_pick('k', CANONICAL_FEATURES)} || chr(9) END AS feature_name,
        kind AS feature_category, persona AS target_persona,
        CASE WHEN k = 5 THEN '2024-1-5' ELSE strftime(DATE '2024-01-01' + size, {D}) END AS release_date,
        CASE k % 3 WHEN 0 THEN ' YES' WHEN 1 THEN '0' ELSE 'maybe' END AS core_feature_flag
    FROM (SELECT CAST(p_partkey % 10 AS INTEGER) AS k, min(p_brand) AS brand, max(p_type) AS kind,
                 CAST(max(p_size) AS INTEGER) AS size, min(p_type) AS persona FROM part GROUP BY 1)
),
clean_features AS (
    SELECT {strip('feature_id')} AS feature_id, {strip('feature_name')} AS feature_name,
        {strip('feature_category')} AS feature_category, {strip('target_persona')} AS target_persona,
        CASE WHEN regexp_full_match(release_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN {sdate('release_date')} END AS release_date,
        {to_bool('core_feature_flag')} AS core_feature_flag
    FROM raw_features WHERE NOT {is_blank('feature_name')}
)"""


def dirty_ctes() -> str:
    bad_d = lambda k: case_pick(f"{k} % 997 - 1", BAD_DATES)
    bad_t = lambda k: case_pick(f"{k} % 997 - 1", BAD_TIMESTAMPS)
    return f"""
ru0 AS (
    SELECT u.user_id AS k,
        CAST(u.user_id AS VARCHAR) AS user_id,
        CASE WHEN u.user_id % 53 = 7 THEN lower(u.business_unit) WHEN u.user_id % 53 = 8 THEN u.business_unit || ' '
             WHEN u.user_id % 53 = 9 AND u.business_unit = 'AUTOMOBILE' THEN 'Auto'
             WHEN u.user_id % 53 = 10 THEN 'Unassigned Unit' ELSE u.business_unit END AS business_unit,
        CASE WHEN u.user_id % 31 = 3 THEN '  ' || u.role || ' ' || chr(9) ELSE u.role END AS role,
        u.region, u.manager_level,
        strftime(u.hire_date, {D}) AS hire_date,
        CASE WHEN u.user_id % 997 BETWEEN 1 AND 4 THEN {bad_d('u.user_id')}
             ELSE strftime(u.assigned_access_date, {D}) END AS assigned_access_date,
        CASE WHEN u.user_id % 89 = 11 THEN 'n/a' ELSE CAST(u.rollout_wave AS VARCHAR) END AS rollout_wave,
        strftime(u.training_assigned_date, {D}) AS training_assigned_date,
        CASE WHEN u.user_id % 61 = 7 AND u.training_assigned_date IS NOT NULL
             THEN strftime(u.training_assigned_date - 2, {D})
             ELSE strftime(u.training_completed_date, {D}) END AS training_completed_date,
        u.training_format,
        {spell_bool('u.manager_champion_flag', 'u.user_id')} AS manager_champion_flag,
        {spell_bool('u.eligible_for_access_flag', 'u.user_id')} AS eligible_for_access_flag,
        0 AS ingest_seq
    FROM users u
),
raw_users AS (
    SELECT * EXCLUDE (k) FROM ru0
    UNION ALL SELECT * EXCLUDE (k) REPLACE ('Unknown Role' AS role, 1 AS ingest_seq) FROM ru0 WHERE k % 250 = 0
),
re0 AS (
    SELECT e.event_id AS k,
        CASE WHEN e.event_id % 401 = 8 THEN e.event_timestamp - INTERVAL 30 DAY
             WHEN e.event_id % 809 = 9 THEN e.event_timestamp + INTERVAL 60 DAY
             ELSE e.event_timestamp END AS ts2,
        e.*
    FROM usage_events e
),
re1 AS (
    SELECT k,
        CAST(event_id AS VARCHAR) AS event_id,
        CAST(user_id AS VARCHAR) AS user_id,
        CASE WHEN k % 997 BETWEEN 1 AND 4 THEN {bad_t('k')} ELSE strftime(ts2, {TS}) END AS event_timestamp,
        session_id,
        {label_dirt('feature_name', 'k')} AS feature_name,
        CASE WHEN k % 41 = 5 THEN chr(10) || event_type || chr(9) ELSE event_type END AS event_type,
        prompt_category, {spell_bool('output_exported_flag', '(k + 1)')} AS output_exported_flag,
        {spell_bool('successful_completion_flag', 'k')} AS successful_completion_flag,
        CASE WHEN k % 331 = 5 THEN '-' || CAST(estimated_minutes_saved AS VARCHAR)
             WHEN k % 29 = 3 THEN CAST(estimated_minutes_saved AS VARCHAR) || '5'
             WHEN estimated_minutes_saved IS NOT NULL AND k % 29 = 4 THEN '0.004'
             ELSE CAST(estimated_minutes_saved AS VARCHAR) END AS estimated_minutes_saved,
        CASE WHEN k % 331 = 6 THEN '-' || CAST(session_duration_seconds AS VARCHAR)
             ELSE CAST(session_duration_seconds AS VARCHAR) END AS session_duration_seconds,
        {spell_bool('error_flag', '(k + 2)')} AS error_flag,
        CASE WHEN k % 37 = 4 THEN platform || ' ' WHEN k % 37 = 5 THEN chr(9) || platform ELSE platform END AS platform,
        source_system,
        0 AS ingest_seq,
        strftime(ts2 + INTERVAL 1 HOUR, {TS}) AS copy_ts
    FROM re0
),
raw_events AS (
    SELECT * EXCLUDE (k, copy_ts) FROM re1
    UNION ALL SELECT * EXCLUDE (k, copy_ts) REPLACE (copy_ts AS event_timestamp, 1 AS ingest_seq) FROM re1 WHERE k % 250 = 0
),
rf0 AS (
    SELECT b.feedback_id AS k,
        CAST(b.feedback_id AS VARCHAR) AS feedback_id,
        CAST(b.user_id AS VARCHAR) AS user_id,
        CASE WHEN b.feedback_id % 997 = 1 THEN 'not_a_date' ELSE strftime(b.feedback_timestamp, {TS}) END AS feedback_timestamp,
        CASE b.feedback_id % 500 WHEN 1 THEN '0' WHEN 2 THEN '6' WHEN 3 THEN '-1'
             ELSE CAST(b.rating_1_to_5 AS VARCHAR) END AS rating_1_to_5,
        b.sentiment_label,
        CASE WHEN b.feedback_id % 71 = 3 THEN b.barrier_category || ' ' || chr(9) ELSE b.barrier_category END AS barrier_category,
        CASE WHEN b.free_text_feedback IS NULL AND b.feedback_id % 2 = 0 THEN '' ELSE b.free_text_feedback END
            AS free_text_feedback,
        {label_dirt('b.feature_name', 'b.feedback_id', 509)} AS feature_name,
        {spell_bool('b.would_recommend_flag', 'b.feedback_id')} AS would_recommend_flag,
        0 AS ingest_seq
    FROM feedback b
),
raw_feedback AS (
    SELECT * EXCLUDE (k) FROM rf0
    UNION ALL SELECT * EXCLUDE (k) REPLACE ('3' AS rating_1_to_5, 1 AS ingest_seq) FROM rf0 WHERE k % 250 = 0
),
raw_training AS (
    SELECT CAST(training_session_id AS VARCHAR) AS training_session_id, strftime(session_date, {D}) AS session_date,
        CASE WHEN training_session_id % 7 = 3 THEN lower(business_unit) ELSE business_unit END AS business_unit,
        training_format, CAST(registered_count AS VARCHAR) AS registered_count,
        CAST(attended_count AS VARCHAR) AS attended_count, CAST(completion_count AS VARCHAR) AS completion_count,
        facilitator, session_topic
    FROM training_sessions
),
raw_calendar AS (
    SELECT strftime(date, {D}) AS date, strftime(week_start_date, {D}) AS week_start_date,
        CAST(week_number AS VARCHAR) AS week_number, CAST(month AS VARCHAR) AS month, month_name,
        CAST(quarter AS VARCHAR) AS quarter, CAST(year AS VARCHAR) AS year
    FROM calendar
)"""


def issue_rows(issues, counts_cte: str, table: str, order: int) -> str:
    parts = []
    for i, s in enumerate(issues):
        n = f"CAST(COALESCE({s.count_col}, 0) AS BIGINT)"
        res_zero = q(s.validated) if s.validated else "NULL"
        parts.append(
            f"SELECT {order} AS table_order, {i + 1} AS issue_order, {q(table)} AS table_name, {q(s.issue_type)} AS issue_type, "
            f"{n} AS affected_record_count, CASE WHEN {n} > 0 THEN {q(s.resolution)} ELSE {res_zero} END AS resolution, "
            f"CASE WHEN {n} > 0 THEN {q(s.status)} ELSE 'Validated (no issue found)' END AS status "
            f"FROM {counts_cte} WHERE {n} > 0 OR {str(s.validated is not None).upper()}")
    return "\nUNION ALL ".join(parts)


def clean_ctes(cfg: AdoptionConfig) -> str:
    from uptake.operators.cleaning import EVENT_ISSUES, FEEDBACK_ISSUES, TRAINING_ISSUES, USER_ISSUES
    bu = lambda x: normalize(x, cfg.canonical_business_units, cfg.business_unit_label_map)
    ft = lambda x: normalize(x, cfg.feature_names, cfg.feature_label_map)
    dates = ["hire_date", "assigned_access_date", "training_assigned_date", "training_completed_date"]
    feats_blank = (*cfg.feature_names, "")
    return f"""{dirty_ctes().strip()},
u_dedup AS (SELECT * FROM raw_users QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ingest_seq) = 1),
u_p0 AS (
    SELECT user_id, business_unit AS _bu_raw, {bu('business_unit')} AS business_unit,
        {strip('role')} AS role, {strip('region')} AS region, {strip('manager_level')} AS manager_level,
        {', '.join(f'{c} AS _{c}_raw, {sdate(c)} AS {c}' for c in dates)},
        {sint('rollout_wave')} AS rollout_wave, {strip('training_format')} AS training_format,
        {to_bool('manager_champion_flag')} AS manager_champion_flag,
        {to_bool('eligible_for_access_flag')} AS eligible_for_access_flag
    FROM u_dedup
),
u_p AS (
    SELECT * REPLACE (CASE WHEN _bad_order THEN NULL ELSE training_completed_date END AS training_completed_date)
    FROM (SELECT *, COALESCE(training_completed_date < training_assigned_date, FALSE) AS _bad_order FROM u_p0) x
),
u_counts AS (
    SELECT
        (SELECT COUNT(*) - COUNT(DISTINCT user_id) FROM raw_users) AS n_dupe,
        COUNT(*) FILTER (WHERE {not_in('_bu_raw', cfg.canonical_business_units)}) AS n_bu_variants,
        COUNT(*) FILTER (WHERE {not_in('business_unit', cfg.canonical_business_units)}) AS n_bu_unmapped,
        COUNT(*) FILTER (WHERE NOT {is_blank('_hire_date_raw')} AND hire_date IS NULL) AS n_bad_hire,
        COUNT(*) FILTER (WHERE NOT {is_blank('_assigned_access_date_raw')} AND assigned_access_date IS NULL) AS n_bad_access,
        COUNT(*) FILTER (WHERE NOT {is_blank('_training_assigned_date_raw')} AND training_assigned_date IS NULL) AS n_bad_tr_assigned,
        COUNT(*) FILTER (WHERE NOT {is_blank('_training_completed_date_raw')} AND training_completed_date IS NULL
                          AND NOT _bad_order) AS n_bad_tr_completed,
        COUNT(*) FILTER (WHERE assigned_access_date IS NULL) AS n_missing_access,
        COUNT(*) FILTER (WHERE manager_champion_flag IS NULL) AS n_missing_champion,
        COUNT(*) FILTER (WHERE _bad_order) AS n_bad_order
    FROM u_p
),
clean_users AS (
    SELECT user_id, business_unit, role, region, manager_level, hire_date, assigned_access_date, rollout_wave,
        training_assigned_date, training_completed_date, training_format, manager_champion_flag, eligible_for_access_flag
    FROM u_p
),
e_dedup AS (SELECT * FROM raw_events QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY ingest_seq) = 1),
e_ts AS (SELECT * REPLACE ({sts('event_timestamp')} AS event_timestamp), event_timestamp AS _ts_raw FROM e_dedup),
quarantine_events AS (SELECT event_id, user_id, _ts_raw AS event_timestamp_raw FROM e_ts WHERE event_timestamp IS NULL),
e_v AS (
    SELECT *, {not_in("COALESCE(feature_name, '')", feats_blank)} AS _f_variant,
        {blank_null(ft('feature_name'))} AS _feature,
        {sdouble('session_duration_seconds')} < 0 AS _neg_dur,
        {smin('estimated_minutes_saved')} < 0 AS _neg_min,
        {sdouble('session_duration_seconds')} AS _dur,
        {smin('estimated_minutes_saved')} AS _min
    FROM e_ts WHERE event_timestamp IS NOT NULL
),
e_j0 AS (
    SELECT v.*, u.assigned_access_date AS _access, CAST(v.event_timestamp AS DATE) AS _date
    FROM e_v v LEFT JOIN clean_users u ON u.user_id = v.user_id
),
e_j AS (
    SELECT *, _access IS NOT NULL AND _date < _access AS _pre,
        COALESCE(NOT (_access IS NOT NULL AND _date < _access) AND _date > (SELECT MAX(date) FROM calendar), FALSE) AS _after
    FROM e_j0
),
e_counts AS (
    SELECT
        (SELECT COUNT(*) - COUNT(DISTINCT event_id) FROM raw_events) AS n_dupe,
        (SELECT COUNT(*) FROM quarantine_events) AS n_bad_ts,
        COUNT(*) FILTER (WHERE _f_variant) AS n_feature_variants,
        COUNT(*) FILTER (WHERE _feature IS NULL) AS n_missing_feature,
        COUNT(*) FILTER (WHERE _neg_dur) AS n_neg_duration,
        COUNT(*) FILTER (WHERE _neg_min) AS n_neg_minutes,
        COUNT(*) FILTER (WHERE _pre) AS n_pre_access,
        COUNT(*) FILTER (WHERE NOT _pre AND _access IS NULL) AS n_no_access,
        COUNT(*) FILTER (WHERE _after) AS n_after_window
    FROM e_j
),
clean_events AS (
    SELECT event_id, user_id, event_timestamp, session_id, _feature AS feature_name, {strip('event_type')} AS event_type, prompt_category,
        {to_bool('output_exported_flag')} AS output_exported_flag,
        {to_bool('successful_completion_flag')} AS successful_completion_flag,
        CASE WHEN NOT _neg_min THEN _min END AS estimated_minutes_saved,
        CASE WHEN NOT _neg_dur THEN _dur END AS session_duration_seconds,
        {strip('platform')} AS platform, {to_bool('error_flag')} AS error_flag,
        source_system, _access IS NULL AS no_access_on_file
    FROM e_j WHERE NOT _pre AND NOT _after
),
f_dedup AS (SELECT * FROM raw_feedback QUALIFY ROW_NUMBER() OVER (PARTITION BY feedback_id ORDER BY ingest_seq) = 1),
f_ts AS (SELECT * REPLACE ({sts('feedback_timestamp')} AS feedback_timestamp), feedback_timestamp AS _ts_raw FROM f_dedup),
quarantine_feedback AS (SELECT feedback_id, user_id, _ts_raw AS feedback_timestamp_raw FROM f_ts WHERE feedback_timestamp IS NULL),
f_v AS (
    SELECT *, {sdouble('rating_1_to_5')} AS _rating,
        {sdouble('rating_1_to_5')} IS NOT NULL AND NOT ({sdouble('rating_1_to_5')} BETWEEN 1 AND 5) AS _bad_rating,
        {not_in("COALESCE(feature_name, '')", feats_blank)} AS _f_variant,
        {blank_null(ft('feature_name'))} AS _feature
    FROM f_ts WHERE feedback_timestamp IS NOT NULL
),
f_counts AS (
    SELECT
        (SELECT COUNT(*) - COUNT(DISTINCT feedback_id) FROM raw_feedback) AS n_dupe,
        (SELECT COUNT(*) FROM quarantine_feedback) AS n_bad_ts,
        COUNT(*) FILTER (WHERE _bad_rating) AS n_bad_rating,
        COUNT(*) FILTER (WHERE _f_variant) AS n_feature_variants,
        COUNT(*) FILTER (WHERE _feature IS NULL) AS n_missing_feature,
        COUNT(*) FILTER (WHERE {is_blank('free_text_feedback')}) AS n_missing_text
    FROM f_v
),
clean_feedback AS (
    SELECT feedback_id, user_id, feedback_timestamp,
        CAST(CASE WHEN NOT _bad_rating THEN _rating END AS INTEGER) AS rating_1_to_5,
        {strip('sentiment_label')} AS sentiment_label, {strip('barrier_category')} AS barrier_category,
        CASE WHEN free_text_feedback <> '' THEN free_text_feedback END AS free_text_feedback,
        _feature AS feature_name, {to_bool('would_recommend_flag')} AS would_recommend_flag
    FROM f_v
),
clean_training AS (
    SELECT training_session_id, {sdate('session_date')} AS session_date, {bu('business_unit')} AS business_unit,
        training_format, {sint('registered_count')} AS registered_count, {sint('attended_count')} AS attended_count,
        {sint('completion_count')} AS completion_count, facilitator, session_topic
    FROM raw_training
),
t_counts AS (
    SELECT COUNT(*) FILTER (WHERE attended_count > registered_count)
             + COUNT(*) FILTER (WHERE completion_count > attended_count) AS n_inconsistent,
        COUNT(*) FILTER (WHERE attended_count > registered_count) AS attended_gt_registered,
        COUNT(*) FILTER (WHERE completion_count > attended_count) AS completed_gt_attended
    FROM clean_training
),
clean_calendar AS (
    SELECT {sdate('date')} AS date, {sdate('week_start_date')} AS week_start_date, {sint('week_number')} AS week_number,
        {sint('month')} AS month, month_name, {sint('quarter')} AS quarter, {sint('year')} AS year
    FROM raw_calendar
),
issue_log AS (
    {issue_rows(USER_ISSUES, 'u_counts', 'users', 1)}
    UNION ALL {issue_rows(EVENT_ISSUES, 'e_counts', 'usage_events', 2)}
    UNION ALL {issue_rows(FEEDBACK_ISSUES, 'f_counts', 'feedback', 3)}
    UNION ALL {issue_rows(TRAINING_ISSUES, 't_counts', 'training_sessions', 4)}
)"""
