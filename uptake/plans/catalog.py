"""Registered queries: key -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, binds the shipped tables with
:func:`uptake.sources.testbind.bind_testdata` and returns a lazy DataFrame
over the whole tables. The oracle is an independent SQL formulation of the
same metric over the same parquet files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.config import ALL_EVENT_TYPES, DEFAULT_CONFIG, TESTDATA_CONFIG, TIME_SAVED_DISCLAIMER, WEEKLY_DISCLAIMER
from uptake.operators import activity, cleaning, features, feedback, population, reports, retention, training, value
from uptake.plans import sqlparts as sp
from uptake.plans.bind_sql import half_up_ratio, pct1, q, with_bind
from uptake.plans.clean_sql import FEATURES
from uptake.plans.sqlparts import in_list
from uptake.sources.testbind import bind_raw_features, bind_testdata, read

CFG = TESTDATA_CONFIG
REF = DEFAULT_CONFIG.with_(  # reference windows (14 / 28 days) on the test vocabulary
    canonical_business_units=TESTDATA_CONFIG.canonical_business_units,
    business_unit_label_map=TESTDATA_CONFIG.business_unit_label_map,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(key: str, sql: str | None, doubles: tuple[str, ...] = ()):
    """Register a query. ``doubles``: exact DECIMAL columns that the registered
    projection emits as DOUBLE on both engines (engines hand decimals to
    clients in different shapes; the library tables keep them exact)."""
    def deco(fn):
        if doubles:
            def run(spark, sf, _fn=fn):
                return _fn(spark, sf).withColumns({c: F.col(c).cast("double") for c in doubles})
            run.__name__ = fn.__name__
            wrapped_sql = None if sql is None else (
                f"SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in doubles)}) FROM ({sql}) _q")
            REGISTRY[key] = (run, wrapped_sql)
        else:
            REGISTRY[key] = (fn, sql)
        return fn
    return deco


_BOUND: dict = {}


def tables(spark: SparkSession, sf_dir: str):
    """Bound tables, built once per (session, folder): they are immutable lazy
    plans, so every query reuses the same analysed DataFrames."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    t = _BOUND.get(key)
    if t is None:
        t = bind_testdata(spark, sf_dir)
        # the calendar (one row per day of the span) is read by nearly every
        # query; keeping it cached saves a min/max pass over events per query
        t = _BOUND[key] = t.replace(calendar=t.calendar.cache())
    return t


M = sp.meaningful(CFG)
ACT = sp.activation_ctes(CFG)
UW = sp.user_weeks(CFG)

# --------------------------------------------------------------------------- population


@register("eligible_users", with_bind("""
SELECT user_id, business_unit, role, rollout_wave, assigned_access_date
FROM users WHERE COALESCE(eligible_for_access_flag, FALSE) AND assigned_access_date IS NOT NULL"""))
def q_eligible_users(spark, sf):
    return population.eligible_users(tables(spark, sf)).select(
        "user_id", "business_unit", "role", "rollout_wave", "assigned_access_date")


@register("actions_in_window", with_bind("SELECT user_id, meaningful_action_count FROM actions", ACT))
def q_actions_in_window(spark, sf):
    return population.actions_in_window(tables(spark, sf), CFG)


@register("qualifying_feature_users", with_bind("SELECT user_id FROM qual", ACT))
def q_qualifying(spark, sf):
    return population.qualifying_feature_users(tables(spark, sf), CFG)


ACT_COLS = ["user_id", "business_unit", "rollout_wave", "meaningful_action_count", "used_qualifying_feature",
            "completed_training", "met_qualification_condition", "activated"]


@register("activation_users", with_bind(f"SELECT {', '.join(ACT_COLS)} FROM activation", ACT))
def q_activation_users(spark, sf):
    return population.activation_users(tables(spark, sf), CFG).select(*ACT_COLS)


def _act_rate_sql(seg: str | None, cte: str = ACT, src: str = "activation") -> str:
    g = f"{seg}, " if seg else ""
    where = f"WHERE {seg} IS NOT NULL" if seg else ""
    gb = f"GROUP BY {seg}" if seg else ""
    return with_bind(f"""
SELECT {g}COUNT(*) AS eligible_users,
       COUNT(*) FILTER (WHERE activated) AS activated_users,
       {pct1('COUNT(*) FILTER (WHERE activated)', 'COUNT(*)')} AS activation_rate_pct
FROM {src} {where} {gb}""", cte)


@register("activation_overall", _act_rate_sql(None))
def q_activation_overall(spark, sf):
    return population.activation_rate(tables(spark, sf), CFG)


@register("activation_by_segment", _act_rate_sql("business_unit"))
def q_activation_by_segment(spark, sf):
    return population.activation_rate(tables(spark, sf), CFG, "business_unit")


@register("activation_by_wave", _act_rate_sql("rollout_wave"))
def q_activation_by_wave(spark, sf):
    return population.activation_rate(tables(spark, sf), CFG, "rollout_wave")


@register("activation_rollup", with_bind(f"""
SELECT 'company' AS level, CAST(NULL AS VARCHAR) AS value, COUNT(*) AS eligible_users, COUNT(*) FILTER (WHERE activated) AS activated_users,
       {pct1('COUNT(*) FILTER (WHERE activated)', 'COUNT(*)')} AS activation_rate_pct FROM activation
UNION ALL SELECT 'business_unit', business_unit, COUNT(*), COUNT(*) FILTER (WHERE activated),
       {pct1('COUNT(*) FILTER (WHERE activated)', 'COUNT(*)')} FROM activation WHERE business_unit IS NOT NULL GROUP BY business_unit
UNION ALL SELECT 'rollout_wave', CAST(rollout_wave AS VARCHAR), COUNT(*), COUNT(*) FILTER (WHERE activated),
       {pct1('COUNT(*) FILTER (WHERE activated)', 'COUNT(*)')} FROM activation WHERE rollout_wave IS NOT NULL GROUP BY rollout_wave""", ACT))
def q_activation_rollup(spark, sf):
    return population.activation_rollup(tables(spark, sf), CFG)


@register("activation_by_wave_ref_windows", _act_rate_sql("rollout_wave", sp.activation_ctes(REF)))
def q_activation_by_wave_ref(spark, sf):
    return population.activation_rate(tables(spark, sf), REF, "rollout_wave")


# --------------------------------------------------------------------------- activity


@register("wau_by_segment", with_bind("""
SELECT uw.week_number, uw.week_start_date, u.business_unit, COUNT(*) AS weekly_active_users
FROM uw JOIN users u ON u.user_id = uw.user_id
WHERE u.business_unit IS NOT NULL
GROUP BY uw.week_number, uw.week_start_date, u.business_unit""", UW))
def q_wau_by_segment(spark, sf):
    return activity.weekly_active_users(tables(spark, sf), CFG, "business_unit")


@register("wau_total", with_bind("""
SELECT week_number, week_start_date, COUNT(*) AS weekly_active_users FROM uw GROUP BY week_number, week_start_date""",
                                 UW))
def q_wau_total(spark, sf):
    return activity.weekly_active_users(tables(spark, sf), CFG)


@register("mau_trailing", with_bind(f"""
SELECT {sp.as_of(CFG)} AS as_of_date, {CFG.trailing_window_days} AS trailing_days,
       COUNT(DISTINCT user_id) AS monthly_active_users
FROM usage_events
WHERE {M} AND CAST(event_timestamp AS DATE) > {sp.as_of(CFG)} - {CFG.trailing_window_days}
  AND CAST(event_timestamp AS DATE) <= {sp.as_of(CFG)}"""))
def q_mau_trailing(spark, sf):
    return activity.mau_trailing(tables(spark, sf), CFG)


TA = sp.trailing_active(CFG)


@register("mau_by_week", with_bind("""
SELECT week_number, week_end_date AS as_of_date, COUNT(*) AS monthly_active_users
FROM tw GROUP BY week_number, week_end_date""", TA))
def q_mau_by_week(spark, sf):
    return activity.mau_by_week(tables(spark, sf), CFG)


@register("stickiness_by_week", with_bind(f"""
SELECT w.week_number, w.week_start_date, m.as_of_date, w.weekly_active_users, m.monthly_active_users,
       {pct1('w.weekly_active_users', 'm.monthly_active_users')} AS stickiness_pct
FROM (SELECT week_number, week_start_date, COUNT(*) AS weekly_active_users FROM uw GROUP BY 1, 2) w
JOIN (SELECT week_number, week_end_date AS as_of_date, COUNT(*) AS monthly_active_users FROM tw GROUP BY 1, 2) m
  ON m.week_number = w.week_number""", UW + "," + TA))
def q_stickiness_by_week(spark, sf):
    return activity.stickiness(tables(spark, sf), CFG)


@register("stickiness_by_segment", with_bind(f"""
SELECT w.week_number, w.week_start_date, m.as_of_date, w.business_unit, w.weekly_active_users,
       m.monthly_active_users, {pct1('w.weekly_active_users', 'm.monthly_active_users')} AS stickiness_pct
FROM (SELECT uw.week_number, uw.week_start_date, u.business_unit, COUNT(*) AS weekly_active_users
      FROM uw JOIN users u ON u.user_id = uw.user_id WHERE u.business_unit IS NOT NULL GROUP BY 1, 2, 3) w
JOIN (SELECT tw.week_number, tw.week_end_date AS as_of_date, u.business_unit, COUNT(*) AS monthly_active_users
      FROM tw JOIN users u ON u.user_id = tw.user_id WHERE u.business_unit IS NOT NULL GROUP BY 1, 2, 3) m
  ON m.week_number = w.week_number AND m.business_unit = w.business_unit""", UW + "," + TA))
def q_stickiness_by_segment(spark, sf):
    return activity.stickiness(tables(spark, sf), CFG, "business_unit")


@register("wau_wow_change", with_bind(f"""
SELECT week_number, week_start_date, business_unit, weekly_active_users,
       LAG(weekly_active_users) OVER (PARTITION BY business_unit ORDER BY week_number) AS prior_week_wau,
       weekly_active_users - LAG(weekly_active_users) OVER (PARTITION BY business_unit ORDER BY week_number) AS wau_change,
       {pct1('weekly_active_users - LAG(weekly_active_users) OVER (PARTITION BY business_unit ORDER BY week_number)',
             'LAG(weekly_active_users) OVER (PARTITION BY business_unit ORDER BY week_number)')} AS wau_change_pct
FROM (
    SELECT g.week_number, g.week_start_date, g.business_unit, CAST(COALESCE(w.n, 0) AS BIGINT) AS weekly_active_users
    FROM (SELECT DISTINCT s.business_unit, c.week_number, c.week_start_date
          FROM (SELECT DISTINCT business_unit FROM users WHERE business_unit IS NOT NULL) s, calendar c) g
    LEFT JOIN (SELECT uw.week_number, u.business_unit, COUNT(*) AS n
               FROM uw JOIN users u ON u.user_id = uw.user_id GROUP BY 1, 2) w
      ON w.week_number = g.week_number AND w.business_unit = g.business_unit
) d""", UW))
def q_wau_wow_change(spark, sf):
    return activity.wau_week_over_week(tables(spark, sf), CFG, "business_unit")


@register("wau_share", with_bind(f"""
SELECT s.week_number, s.week_start_date, s.business_unit, s.weekly_active_users, c.company_wau,
       {pct1('s.weekly_active_users', 'c.company_wau')} AS pct_of_company_wau
FROM (SELECT uw.week_number, uw.week_start_date, u.business_unit, COUNT(*) AS weekly_active_users
      FROM uw JOIN users u ON u.user_id = uw.user_id WHERE u.business_unit IS NOT NULL GROUP BY 1, 2, 3) s
JOIN (SELECT week_number, COUNT(*) AS company_wau FROM uw GROUP BY 1) c ON c.week_number = s.week_number""", UW))
def q_wau_share(spark, sf):
    return activity.wau_share(tables(spark, sf), CFG)


# --------------------------------------------------------------------------- features

ELIG = """eligible AS (
    SELECT * FROM users WHERE COALESCE(eligible_for_access_flag, FALSE) AND assigned_access_date IS NOT NULL
)"""
ADOPT = f"""adopt AS (
    SELECT DISTINCT user_id, feature_name FROM usage_events
    WHERE event_type IN {in_list(CFG.adoption_event_types)} AND feature_name IS NOT NULL
)"""


def _feature_adoption_sql(segs: list[str]) -> str:
    g = "".join(f"e.{s}, " for s in segs)
    g2 = "".join(f"d.{s}, " for s in segs)
    on = "".join(f" AND a.{s} = d.{s}" for s in segs)
    where = " AND ".join(f"e.{s} IS NOT NULL" for s in segs) or "TRUE"
    grp = ", ".join(f"e.{s}" for s in segs)
    gb = f"GROUP BY {grp}" if segs else ""
    return with_bind(f"""
SELECT {g2}f.feature_name, d.eligible_users, CAST(COALESCE(a.n, 0) AS BIGINT) AS adopted_users,
       {pct1('COALESCE(a.n, 0)', 'd.eligible_users')} AS feature_adoption_rate_pct
FROM (SELECT {g}COUNT(*) AS eligible_users FROM eligible e WHERE {where} {gb}) d
CROSS JOIN feature_catalog f
LEFT JOIN (SELECT {g}x.feature_name, COUNT(*) AS n FROM adopt x JOIN eligible e ON e.user_id = x.user_id
           WHERE {where} GROUP BY {g}x.feature_name) a
  ON a.feature_name = f.feature_name{on}""", ELIG + ",\n" + ADOPT)


@register("feature_adoption", _feature_adoption_sql([]))
def q_feature_adoption(spark, sf):
    return features.feature_adoption(tables(spark, sf), CFG)


@register("feature_adoption_by_segment", _feature_adoption_sql(["business_unit"]))
def q_feature_adoption_by_segment(spark, sf):
    return features.feature_adoption(tables(spark, sf), CFG, "business_unit")


@register("feature_adoption_bu_role", _feature_adoption_sql(["business_unit", "role"]))
def q_feature_adoption_bu_role(spark, sf):
    return features.feature_adoption(tables(spark, sf), CFG, ["business_unit", "role"])


@register("core_feature_adoption", with_bind(f"""
SELECT COUNT(*) AS eligible_users, COUNT(c.user_id) AS core_adopters,
       {pct1('COUNT(c.user_id)', 'COUNT(*)')} AS core_feature_adoption_rate_pct
FROM eligible e
LEFT JOIN (SELECT DISTINCT a.user_id FROM adopt a JOIN feature_catalog f
           ON f.feature_name = a.feature_name AND f.core_feature_flag) c ON c.user_id = e.user_id""",
    ELIG + ",\n" + ADOPT))
def q_core_feature_adoption(spark, sf):
    return features.core_feature_adoption(tables(spark, sf), CFG)


def _pivot_cols(values, value_expr: str, key_col: str, agg: str = "MAX") -> str:
    return ", ".join(f'{agg}(CASE WHEN {key_col} = {q(v)} THEN {value_expr} END) AS "{v}"' for v in values)


@register("role_feature_matrix", f"""SELECT role, {_pivot_cols(CFG.feature_names, 'feature_adoption_rate_pct', 'feature_name')}
FROM ({_feature_adoption_sql(['role'])}) x GROUP BY role""")
def q_role_feature_matrix(spark, sf):
    return features.role_feature_matrix(tables(spark, sf), CFG)


@register("feature_usage_trend", with_bind(f"""
SELECT c.week_number, f.feature_name, COUNT(DISTINCT f.user_id) AS adopting_users
FROM usage_events f JOIN calendar c ON c.date = CAST(f.event_timestamp AS DATE)
WHERE f.event_type IN {in_list(CFG.adoption_event_types)} AND f.feature_name IS NOT NULL
GROUP BY c.week_number, f.feature_name"""))
def q_feature_usage_trend(spark, sf):
    return features.feature_usage_trend(tables(spark, sf), CFG)


# --------------------------------------------------------------------------- value

TTV = f"""fv AS (
    SELECT user_id, MIN(event_timestamp) AS first_value_ts FROM usage_events
    WHERE event_type IN {in_list(CFG.value_event_types)} AND COALESCE(successful_completion_flag, FALSE)
    GROUP BY user_id
),
ttv AS (
    SELECT u.*, fv.first_value_ts,
           CAST(date_diff('microsecond', CAST(u.assigned_access_date AS TIMESTAMP), fv.first_value_ts) AS DOUBLE)
               / 3600000000.0 AS hours_to_value
    FROM users u JOIN fv ON fv.user_id = u.user_id
    WHERE u.assigned_access_date IS NOT NULL AND fv.first_value_ts >= CAST(u.assigned_access_date AS TIMESTAMP)
)"""


@register("time_to_value", with_bind(
    "SELECT user_id, business_unit, role, first_value_ts, hours_to_value FROM ttv", TTV))
def q_time_to_value(spark, sf):
    return value.time_to_value(tables(spark, sf), CFG).select(
        "user_id", "business_unit", "role", "first_value_ts", "hours_to_value")


@register("median_ttv_by_segment", with_bind("""
SELECT business_unit, COUNT(*) AS users_with_first_value,
       ROUND(quantile_cont(hours_to_value, 0.5), 1) AS median_hours_to_value
FROM ttv WHERE business_unit IS NOT NULL GROUP BY business_unit""", TTV))
def q_median_ttv_by_segment(spark, sf):
    return value.median_time_to_value(tables(spark, sf), CFG, "business_unit")


@register("median_ttv_overall", with_bind("""
SELECT COUNT(*) AS users_with_first_value, ROUND(quantile_cont(hours_to_value, 0.5), 1) AS median_hours_to_value
FROM ttv""", TTV))
def q_median_ttv_overall(spark, sf):
    return value.median_time_to_value(tables(spark, sf), CFG)


@register("ttv_histogram", with_bind(f"""
SELECT CAST(floor(hours_to_value / {CFG.ttv_bin_hours}) * {CFG.ttv_bin_hours} AS BIGINT) AS bin_start_hours,
       COUNT(*) AS users
FROM ttv GROUP BY 1""", TTV))
def q_ttv_histogram(spark, sf):
    return value.ttv_histogram(tables(spark, sf), CFG)


@register("ttv_histogram_clipped", with_bind("""
SELECT g.bin, s.lo + g.bin * s.width AS bin_start_hours, s.lo + (g.bin + 1) * s.width AS bin_end_hours,
       (SELECT COUNT(*) FROM clipped c WHERE least(floor((c.x - s.lo) / s.width), 39) = g.bin) AS users
FROM (SELECT CASE WHEN max(x) > min(x) THEN min(x) ELSE min(x) - 0.5 END AS lo,
             CASE WHEN max(x) > min(x) THEN max(x) - min(x) ELSE 1.0 END / 40 AS width FROM clipped HAVING COUNT(*) > 0) s,
     (SELECT CAST(unnest(range(40)) AS INTEGER) AS bin) g""",
    TTV + ",\nclipped AS (SELECT least(hours_to_value, 200.0) AS x FROM ttv)"))
def q_ttv_histogram_clipped(spark, sf):
    return value.ttv_histogram_clipped(tables(spark, sf), CFG)


@register("time_saved_by_feature", with_bind(f"""
SELECT feature_name, successful_actions_with_estimate,
       {half_up_ratio('cents', '100', 0)} AS total_estimated_minutes_saved,
       {half_up_ratio('cents', '6000', 1)} AS total_estimated_hours_saved,
       {half_up_ratio('cents', 'successful_actions_with_estimate * 100', 1)} AS avg_estimated_minutes_saved_per_action,
       {q(TIME_SAVED_DISCLAIMER)} AS disclaimer
FROM (SELECT e.feature_name, COUNT(e.estimated_minutes_saved) AS successful_actions_with_estimate,
             CAST(SUM(e.estimated_minutes_saved) * 100 AS BIGINT) AS cents
      FROM usage_events e JOIN feature_catalog f ON f.feature_name = e.feature_name
      GROUP BY e.feature_name) x"""))
def q_time_saved_by_feature(spark, sf):
    return value.time_saved_by_feature(tables(spark, sf), CFG)


@register("time_saved_value_events", with_bind(f"""
SELECT feature_name, successful_actions_with_estimate,
       {half_up_ratio('cents', '100', 1)} AS total_estimated_minutes_saved,
       {half_up_ratio('cents', 'successful_actions_with_estimate * 100', 1)} AS avg_estimated_minutes_saved_per_action,
       {half_up_ratio('(cents * 20 + 100) // 200', '600', 1)} AS total_estimated_hours_saved,
       {q(TIME_SAVED_DISCLAIMER)} AS disclaimer
FROM (SELECT feature_name, COUNT(*) AS successful_actions_with_estimate,
             CAST(SUM(estimated_minutes_saved) * 100 AS BIGINT) AS cents
      FROM usage_events
      WHERE event_type IN {in_list(CFG.value_event_types)} AND COALESCE(successful_completion_flag, FALSE)
        AND estimated_minutes_saved IS NOT NULL AND feature_name IS NOT NULL
      GROUP BY feature_name) x"""))
def q_time_saved_value_events(spark, sf):
    return value.time_saved_value_events(tables(spark, sf), CFG)


# --------------------------------------------------------------------------- retention

COH = f"""uwk AS (
    SELECT DISTINCT f.user_id, c.week_number
    FROM usage_events f JOIN calendar c ON c.date = CAST(f.event_timestamp AS DATE) WHERE f.{M}
),
coh AS (SELECT user_id, MIN(week_number) AS cohort_week FROM uwk GROUP BY user_id),
sizes AS (SELECT cohort_week, COUNT(*) AS cohort_users FROM coh GROUP BY cohort_week),
cells AS (
    SELECT c.cohort_week, u.week_number - c.cohort_week AS weeks_since_activation, COUNT(*) AS active_users
    FROM coh c JOIN uwk u ON u.user_id = c.user_id
    WHERE u.week_number - c.cohort_week BETWEEN 0 AND {CFG.retention_max_weeks}
    GROUP BY 1, 2
),
ret AS (
    SELECT x.cohort_week, s.cohort_users, x.weeks_since_activation, x.active_users,
           {pct1('x.active_users', 's.cohort_users')} AS retention_rate_pct
    FROM cells x JOIN sizes s ON s.cohort_week = x.cohort_week
),
grid AS (
    SELECT s.cohort_week, s.cohort_users, CAST(g.w AS INTEGER) AS weeks_since_activation,
           CAST(COALESCE(r.active_users, 0) AS BIGINT) AS active_users,
           COALESCE(r.retention_rate_pct, 0.0) AS retention_rate_pct
    FROM sizes s CROSS JOIN range(0, {CFG.retention_max_weeks + 1}) g(w)
    LEFT JOIN ret r ON r.cohort_week = s.cohort_week AND r.weeks_since_activation = g.w
)"""


@register("retention_cohorts", with_bind("SELECT * FROM ret", COH))
def q_retention_cohorts(spark, sf):
    return retention.retention_cohorts(tables(spark, sf), CFG)


@register("activation_week", with_bind(f"""
SELECT f.user_id, f.first_meaningful_ts, c.week_number AS activation_week
FROM (SELECT user_id, MIN(event_timestamp) AS first_meaningful_ts FROM usage_events WHERE {M} GROUP BY user_id) f
LEFT JOIN calendar c ON c.date = CAST(f.first_meaningful_ts AS DATE)"""))
def q_activation_week(spark, sf):
    return retention.activation_week(tables(spark, sf), CFG)


@register("retention_matrix", with_bind(f"""
SELECT cohort_week, cohort_users,
       {', '.join(f'MAX(CASE WHEN weeks_since_activation = {i} THEN retention_rate_pct END) AS week_{i}'
                  for i in range(CFG.retention_max_weeks + 1))}
FROM grid GROUP BY cohort_week, cohort_users""", COH))
def q_retention_matrix(spark, sf):
    return retention.retention_matrix(tables(spark, sf), CFG)


@register("retention_w1_w4", with_bind("""
SELECT cohort_week, cohort_users,
       MAX(CASE WHEN weeks_since_activation = 1 THEN retention_rate_pct END) AS week1_retention_pct,
       MAX(CASE WHEN weeks_since_activation = 4 THEN retention_rate_pct END) AS week4_retention_pct
FROM grid GROUP BY cohort_week, cohort_users""", COH))
def q_retention_w1_w4(spark, sf):
    return retention.retention_w1_w4(tables(spark, sf), CFG)


def _dormancy_sql(cfg, seg: str = "business_unit") -> str:
    n = cfg.trailing_window_days
    return with_bind(f"""
SELECT a.{seg}, COUNT(*) AS activated_users, COUNT(*) FILTER (WHERE r.user_id IS NULL) AS dormant_users,
       {pct1('COUNT(*) FILTER (WHERE r.user_id IS NULL)', 'COUNT(*)')} AS dormancy_rate_pct
FROM (SELECT * FROM activation WHERE activated AND {seg} IS NOT NULL) a
LEFT JOIN (SELECT DISTINCT user_id FROM usage_events
           WHERE {sp.meaningful(cfg)} AND CAST(event_timestamp AS DATE) > {sp.as_of(cfg)} - {n}
             AND CAST(event_timestamp AS DATE) <= {sp.as_of(cfg)}) r ON r.user_id = a.user_id
GROUP BY a.{seg}""", sp.activation_ctes(cfg))


@register("dormancy_by_segment", _dormancy_sql(CFG))
def q_dormancy_by_segment(spark, sf):
    return retention.dormant_users(tables(spark, sf), CFG, "business_unit")


@register("dormancy_by_segment_ref_windows", _dormancy_sql(REF))
def q_dormancy_ref(spark, sf):
    return retention.dormant_users(tables(spark, sf), REF, "business_unit")


@register("dormancy_trend", with_bind(f"""
SELECT w.week_number, w.week_end_date AS as_of_date, b.activated_users,
       b.activated_users - COALESCE(x.n, 0) AS dormant_users,
       {pct1('b.activated_users - COALESCE(x.n, 0)', 'b.activated_users')} AS dormancy_rate_pct
FROM (SELECT COUNT(*) AS activated_users FROM activation WHERE activated) b
CROSS JOIN we w
LEFT JOIN (SELECT tw.week_number, COUNT(*) AS n FROM tw JOIN activation a ON a.user_id = tw.user_id AND a.activated
           GROUP BY tw.week_number) x ON x.week_number = w.week_number""", ACT + "," + TA))
def q_dormancy_trend(spark, sf):
    return retention.dormancy_trend(tables(spark, sf), CFG)


# --------------------------------------------------------------------------- training


def _training_sql(seg: str | None) -> str:
    g = f"{seg}, " if seg else ""
    return with_bind(f"""
SELECT {g}COUNT(*) AS users_assigned,
       COUNT(*) FILTER (WHERE training_completed_date IS NOT NULL) AS users_completed,
       {pct1('COUNT(*) FILTER (WHERE training_completed_date IS NOT NULL)', 'COUNT(*)')} AS training_completion_rate_pct
FROM users WHERE training_assigned_date IS NOT NULL {f'AND {seg} IS NOT NULL GROUP BY {seg}' if seg else ''}""")


@register("training_completion", _training_sql(None))
def q_training_completion(spark, sf):
    return training.training_completion(tables(spark, sf))


@register("training_completion_by_segment", _training_sql("business_unit"))
def q_training_completion_by_segment(spark, sf):
    return training.training_completion(tables(spark, sf), "business_unit")


@register("training_vs_activation", with_bind(f"""
SELECT CASE WHEN completed_training THEN 'Completed Training' ELSE 'Did Not Complete Training' END AS training_status,
       COUNT(*) AS eligible_users, COUNT(*) FILTER (WHERE activated) AS activated_users,
       {pct1('COUNT(*) FILTER (WHERE activated)', 'COUNT(*)')} AS activation_rate_pct
FROM activation GROUP BY 1""", ACT))
def q_training_vs_activation(spark, sf):
    return training.training_vs_activation(tables(spark, sf), CFG)


@register("training_attendance_by_segment", with_bind(f"""
SELECT business_unit, sessions, registered, attended, completed,
       {pct1('attended', 'registered')} AS attendance_rate_pct, {pct1('completed', 'attended')} AS completion_rate_pct
FROM (SELECT business_unit, COUNT(*) AS sessions, CAST(SUM(registered_count) AS BIGINT) AS registered,
             CAST(SUM(attended_count) AS BIGINT) AS attended, CAST(SUM(completion_count) AS BIGINT) AS completed
      FROM training_sessions WHERE business_unit IS NOT NULL GROUP BY business_unit) x"""))
def q_training_attendance(spark, sf):
    return training.training_attendance(tables(spark, sf))


# --------------------------------------------------------------------------- feedback

NB = q(CFG.no_barrier_label)


def _rec_sql(seg: str | None) -> str:
    if seg:
        return with_bind(f"""
SELECT u.{seg}, COUNT(*) AS feedback_submissions, COUNT(*) FILTER (WHERE f.would_recommend_flag) AS recommend_count,
       {pct1('COUNT(*) FILTER (WHERE f.would_recommend_flag)', 'COUNT(*)')} AS recommendation_rate_pct
FROM feedback f JOIN users u ON u.user_id = f.user_id
WHERE f.would_recommend_flag IS NOT NULL AND u.{seg} IS NOT NULL GROUP BY u.{seg}""")
    return with_bind(f"""
SELECT COUNT(*) AS feedback_submissions, COUNT(*) FILTER (WHERE would_recommend_flag) AS recommend_count,
       {pct1('COUNT(*) FILTER (WHERE would_recommend_flag)', 'COUNT(*)')} AS recommendation_rate_pct
FROM feedback WHERE would_recommend_flag IS NOT NULL""")


@register("recommendation_rate", _rec_sql(None))
def q_recommendation_rate(spark, sf):
    return feedback.recommendation_rate(tables(spark, sf))


@register("recommendation_by_segment", _rec_sql("business_unit"))
def q_recommendation_by_segment(spark, sf):
    return feedback.recommendation_rate(tables(spark, sf), "business_unit")


@register("avg_rating_by_feature", with_bind(f"""
SELECT feature_name, COUNT(*) AS feedback_submissions, COUNT(rating_1_to_5) AS rated_submissions,
       {half_up_ratio('SUM(rating_1_to_5)', 'COUNT(rating_1_to_5)', 2)} AS avg_rating
FROM feedback WHERE feature_name IS NOT NULL GROUP BY feature_name"""))
def q_avg_rating_by_feature(spark, sf):
    return feedback.avg_rating(tables(spark, sf), "feature_name")


BC = f"""bc AS (
    SELECT u.business_unit, f.barrier_category, COUNT(*) AS mentions
    FROM feedback f JOIN users u ON u.user_id = f.user_id
    WHERE f.barrier_category IS NOT NULL AND f.barrier_category <> {NB} AND u.business_unit IS NOT NULL
    GROUP BY u.business_unit, f.barrier_category
),
br AS (
    SELECT business_unit, barrier_category, mentions,
           {pct1('mentions', 'SUM(mentions) OVER (PARTITION BY business_unit)')} AS pct_of_barrier_mentions,
           RANK() OVER (PARTITION BY business_unit ORDER BY mentions DESC) AS barrier_rank
    FROM bc
)"""


@register("barrier_ranking", with_bind("SELECT * FROM br", BC))
def q_barrier_ranking(spark, sf):
    return feedback.barrier_ranking(tables(spark, sf), CFG)


@register("top_barriers_with_ties", with_bind("SELECT * FROM br WHERE barrier_rank = 1", BC))
def q_top_barriers_with_ties(spark, sf):
    return feedback.top_barriers_with_ties(tables(spark, sf), CFG)


@register("top_barrier", with_bind(f"""
SELECT barrier_category AS top_barrier, mentions FROM (
    SELECT barrier_category, COUNT(*) AS mentions,
           ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, barrier_category) AS rn
    FROM feedback WHERE barrier_category IS NOT NULL AND barrier_category <> {NB} GROUP BY barrier_category
) x WHERE rn = 1"""))
def q_top_barrier(spark, sf):
    return feedback.top_barrier(tables(spark, sf), CFG)


WF = f"""wf AS (
    SELECT c.week_number, u.business_unit, COUNT(*) AS feedback_submissions,
           {half_up_ratio('SUM(f.rating_1_to_5)', 'COUNT(f.rating_1_to_5)', 2)} AS avg_rating,
           {pct1('COUNT(*) FILTER (WHERE f.would_recommend_flag)', 'COUNT(*)')} AS recommendation_rate_pct
    FROM feedback f JOIN calendar c ON c.date = CAST(f.feedback_timestamp AS DATE)
    JOIN users u ON u.user_id = f.user_id
    WHERE u.business_unit IS NOT NULL
    GROUP BY c.week_number, u.business_unit
)"""


@register("weekly_feedback", with_bind("SELECT * FROM wf", WF))
def q_weekly_feedback(spark, sf):
    return feedback.weekly_feedback(tables(spark, sf))


@register("feedback_anonymised", with_bind("""
SELECT f.feedback_id, f.feedback_timestamp, u.business_unit, f.feature_name, f.rating_1_to_5, f.sentiment_label,
       f.barrier_category, f.free_text_feedback, f.would_recommend_flag
FROM feedback f LEFT JOIN (SELECT user_id, business_unit FROM users WHERE business_unit IS NOT NULL) u
  ON u.user_id = f.user_id"""))
def q_feedback_anonymised(spark, sf):
    return feedback.feedback_anonymised(tables(spark, sf))


# --------------------------------------------------------------------------- reports

WI = f"""me AS (
    SELECT f.user_id, f.feature_name, f.estimated_minutes_saved, c.week_number, c.week_start_date, u.business_unit
    FROM usage_events f
    JOIN calendar c ON c.date = CAST(f.event_timestamp AS DATE)
    JOIN users u ON u.user_id = f.user_id
    WHERE f.{M}
),
wau AS (
    SELECT week_number, week_start_date, business_unit, COUNT(DISTINCT user_id) AS wau,
           CAST(COALESCE(SUM(estimated_minutes_saved), 0) * 100 AS BIGINT) AS cents,
           COUNT(DISTINCT CASE WHEN feature_name = {q(CFG.qualifying_feature)} THEN user_id END) AS pl
    FROM me WHERE business_unit IS NOT NULL GROUP BY 1, 2, 3
),
cw AS (SELECT week_number, COUNT(DISTINCT user_id) AS company_wau FROM me GROUP BY 1),
{WF.strip()},
tb AS (
    SELECT week_number, business_unit, barrier_category FROM (
        SELECT c.week_number, u.business_unit, f.barrier_category,
               ROW_NUMBER() OVER (PARTITION BY c.week_number, u.business_unit
                                  ORDER BY COUNT(*) DESC, f.barrier_category) AS rn
        FROM feedback f JOIN calendar c ON c.date = CAST(f.feedback_timestamp AS DATE)
        JOIN users u ON u.user_id = f.user_id
        WHERE f.barrier_category IS NOT NULL AND f.barrier_category <> {NB} AND u.business_unit IS NOT NULL
        GROUP BY c.week_number, u.business_unit, f.barrier_category
    ) r WHERE rn = 1
)"""
WI_BODY = f"""
SELECT w.week_number, w.week_start_date, w.business_unit, w.wau AS weekly_active_users,
       LAG(w.wau) OVER (PARTITION BY w.business_unit ORDER BY w.week_number) AS prior_week_wau,
       w.wau - LAG(w.wau) OVER (PARTITION BY w.business_unit ORDER BY w.week_number) AS wau_change_vs_prior_week,
       {pct1('w.wau', 'cw.company_wau')} AS pct_of_company_wau_this_week,
       w.pl AS prompt_library_users,
       {half_up_ratio('w.cents', '6000', 1)} AS estimated_hours_saved_modeled,
       CAST(COALESCE(fb.feedback_submissions, 0) AS BIGINT) AS feedback_submissions,
       fb.avg_rating, fb.recommendation_rate_pct,
       tb.barrier_category AS top_reported_barrier,
       {q(WEEKLY_DISCLAIMER)} AS disclaimer
FROM wau w
JOIN cw ON cw.week_number = w.week_number
LEFT JOIN wf fb ON fb.week_number = w.week_number AND fb.business_unit = w.business_unit
LEFT JOIN tb ON tb.week_number = w.week_number AND tb.business_unit = w.business_unit"""


@register("weekly_insights", with_bind(WI_BODY, WI))
def q_weekly_insights(spark, sf):
    return reports.weekly_insights(tables(spark, sf), CFG)


SC = f"""{ACT.strip()},
{TTV.strip()},
{sp.trailing_active(CFG).strip()},
act_bu AS (
    SELECT business_unit, COUNT(*) AS eligible_users, COUNT(*) FILTER (WHERE activated) AS activated_users,
           {pct1('COUNT(*) FILTER (WHERE activated)', 'COUNT(*)')} AS activation_rate_pct
    FROM activation WHERE business_unit IS NOT NULL GROUP BY business_unit
),
ttv_bu AS (
    SELECT business_unit, ROUND(quantile_cont(hours_to_value, 0.5), 1) AS median_hours_to_value
    FROM ttv WHERE business_unit IS NOT NULL GROUP BY business_unit
),
tr_bu AS (
    SELECT business_unit, {pct1('COUNT(*) FILTER (WHERE training_completed_date IS NOT NULL)', 'COUNT(*)')}
               AS training_completion_rate_pct
    FROM users WHERE training_assigned_date IS NOT NULL AND business_unit IS NOT NULL GROUP BY business_unit
),
dorm_bu AS (
    SELECT a.business_unit,
           {pct1('COUNT(*) FILTER (WHERE r.user_id IS NULL)', 'COUNT(*)')} AS dormancy_rate_pct
    FROM (SELECT * FROM activation WHERE activated AND business_unit IS NOT NULL) a
    LEFT JOIN (SELECT DISTINCT user_id FROM usage_events
               WHERE {M} AND CAST(event_timestamp AS DATE) > {sp.as_of(CFG)} - {CFG.trailing_window_days}
                 AND CAST(event_timestamp AS DATE) <= {sp.as_of(CFG)}) r ON r.user_id = a.user_id
    GROUP BY a.business_unit
),
sc AS (
    SELECT a.business_unit, a.eligible_users, a.activated_users, a.activation_rate_pct / 100.0 AS activation_rate,
           t.median_hours_to_value, r.training_completion_rate_pct / 100.0 AS training_completion_rate,
           d.dormancy_rate_pct / 100.0 AS dormancy_rate
    FROM act_bu a LEFT JOIN ttv_bu t ON t.business_unit = a.business_unit
    LEFT JOIN tr_bu r ON r.business_unit = a.business_unit
    LEFT JOIN dorm_bu d ON d.business_unit = a.business_unit
)"""


@register("segment_scorecard", with_bind("SELECT * FROM sc", SC))
def q_segment_scorecard(spark, sf):
    return reports.segment_scorecard(tables(spark, sf), CFG)


FS_BODY = f"""{ADOPT},
fa AS (
    SELECT f.feature_name, d.eligible_users, CAST(COALESCE(a.n, 0) AS BIGINT) AS adopted_users,
           {pct1('COALESCE(a.n, 0)', 'd.eligible_users')} AS feature_adoption_rate_pct
    FROM (SELECT COUNT(*) AS eligible_users FROM eligible) d CROSS JOIN feature_catalog f
    LEFT JOIN (SELECT x.feature_name, COUNT(*) AS n FROM adopt x JOIN eligible e ON e.user_id = x.user_id
               GROUP BY x.feature_name) a ON a.feature_name = f.feature_name
),
saved AS (
    SELECT feature_name, {half_up_ratio('(cents * 20 + 100) // 200', '600', 1)} AS total_estimated_hours_saved
    FROM (SELECT feature_name, CAST(SUM(estimated_minutes_saved) * 100 AS BIGINT) AS cents FROM usage_events
          WHERE event_type IN {in_list(CFG.value_event_types)} AND COALESCE(successful_completion_flag, FALSE)
            AND estimated_minutes_saved IS NOT NULL AND feature_name IS NOT NULL GROUP BY feature_name) x
),
fs AS (
    SELECT fa.feature_name, fa.eligible_users, fa.adopted_users, fa.feature_adoption_rate_pct / 100.0
               AS feature_adoption_rate, s.total_estimated_hours_saved
    FROM fa LEFT JOIN saved s ON s.feature_name = fa.feature_name
)"""
FS = ELIG + ",\n" + FS_BODY


@register("feature_scorecard", with_bind("SELECT * FROM fs", FS))
def q_feature_scorecard(spark, sf):
    return reports.feature_scorecard(tables(spark, sf), CFG)


BARRIERS = [b for b in CFG.barrier_categories if b != CFG.no_barrier_label]


@register("barrier_matrix", with_bind(f"""
SELECT business_unit, {', '.join(f'CAST(COALESCE(SUM(CASE WHEN barrier_category = {q(b)} THEN mentions END), 0) AS BIGINT) AS "{b}"' for b in BARRIERS)}
FROM bc GROUP BY business_unit""", BC))
def q_barrier_matrix(spark, sf):
    return reports.barrier_matrix(tables(spark, sf), CFG)


@register("feature_usage_matrix", with_bind(f"""
SELECT f.feature_name, {', '.join(f'CAST(COUNT(*) FILTER (WHERE u.business_unit = {q(b)}) AS BIGINT) AS "{b}"' for b in CFG.canonical_business_units)}
FROM usage_events f JOIN users u ON u.user_id = f.user_id
WHERE f.event_type IN {in_list(CFG.adoption_event_types)} AND f.feature_name IS NOT NULL AND u.business_unit IS NOT NULL
GROUP BY f.feature_name"""))
def q_feature_usage_matrix(spark, sf):
    return reports.feature_usage_matrix(tables(spark, sf), CFG)


@register("wau_matrix", with_bind(f"""
SELECT uw.week_number, {', '.join(f'CAST(COUNT(*) FILTER (WHERE u.business_unit = {q(b)}) AS BIGINT) AS "{b}"' for b in CFG.canonical_business_units)}
FROM uw JOIN users u ON u.user_id = uw.user_id WHERE u.business_unit IS NOT NULL GROUP BY uw.week_number""", UW))
def q_wau_matrix(spark, sf):
    return reports.wau_matrix(tables(spark, sf), CFG)


KPI_FROM_WEEK = 3


@register("headline_kpis", with_bind(f"""
SELECT a.total_eligible_users, a.total_activated_users,
       CAST(a.total_activated_users AS DOUBLE) / NULLIF(CAST(a.total_eligible_users AS DOUBLE), 0) AS company_activation_rate,
       CAST(a.tr_tenths AS DOUBLE) / CAST(a.tr_n * 1000 AS DOUBLE) AS avg_training_completion_rate,
       a.segments_below_threshold, w.total_wau_from_week, f.features_above_threshold,
       CAST(f.hours_tenths AS DOUBLE) / 10.0 AS total_estimated_hours_saved
FROM (SELECT CAST(SUM(sc.eligible_users) AS BIGINT) AS total_eligible_users,
             CAST(SUM(sc.activated_users) AS BIGINT) AS total_activated_users,
             CAST(SUM(CAST(t.training_completion_rate_pct * 10 AS BIGINT)) AS BIGINT) AS tr_tenths,
             COUNT(t.training_completion_rate_pct) AS tr_n,
             COUNT(*) FILTER (WHERE sc.activation_rate < 0.75) AS segments_below_threshold
      FROM sc LEFT JOIN tr_bu t ON t.business_unit = sc.business_unit) a,
     (SELECT CAST(SUM(n) AS BIGINT) AS total_wau_from_week FROM
        (SELECT week_number, COUNT(*) AS n FROM uw GROUP BY week_number) x WHERE week_number >= {KPI_FROM_WEEK}) w,
     (SELECT COUNT(*) FILTER (WHERE feature_adoption_rate > 0.5) AS features_above_threshold,
             CAST(SUM(CAST(total_estimated_hours_saved * 10 AS BIGINT)) AS BIGINT) AS hours_tenths FROM fs) f""",
    SC + ",\n" + UW.strip() + ",\n" + FS_BODY))
def q_headline_kpis(spark, sf):
    return reports.headline_kpis(tables(spark, sf), CFG, wau_from_week=KPI_FROM_WEEK)


LOOKUP = "BUILDING"


@register("segment_lookup", with_bind(f"""
SELECT {q(LOOKUP)} AS business_unit, CASE WHEN COUNT(*) > 0 THEN 'Found' ELSE 'Not found' END AS lookup_status,
       MAX(activation_rate) AS activation_rate, MAX(median_hours_to_value) AS median_hours_to_value,
       MAX(dormancy_rate) AS dormancy_rate
FROM sc WHERE business_unit = {q(LOOKUP)}""", SC))
def q_segment_lookup(spark, sf):
    return reports.segment_lookup(tables(spark, sf), CFG, LOOKUP)


@register("low_adoption_segments", with_bind(f"""
SELECT CAST({CFG.low_adoption_threshold} AS DOUBLE) AS threshold,
       COUNT(*) FILTER (WHERE CAST(activated_users AS DOUBLE) / CAST(eligible_users AS DOUBLE) < {CFG.low_adoption_threshold})
           AS low_adoption_segments,
       COUNT(*) AS segments
FROM (SELECT business_unit, COUNT(*) AS eligible_users, COUNT(*) FILTER (WHERE activated) AS activated_users
      FROM activation WHERE business_unit IS NOT NULL GROUP BY business_unit) x""", ACT))
def q_low_adoption_segments(spark, sf):
    return reports.low_adoption_segments(tables(spark, sf), CFG)


@register("adoption_funnel", with_bind(f"""
SELECT stage_order, stage, users, {pct1('users', 'FIRST_VALUE(users) OVER (ORDER BY stage_order)')} AS pct_of_eligible,
       LAG(users) OVER (ORDER BY stage_order) - users AS drop_off_from_previous
FROM (
    SELECT 1 AS stage_order, 'Eligible users' AS stage, COUNT(*) AS users FROM activation
    UNION ALL SELECT 2, 'Completed training', COUNT(*) FILTER (WHERE completed_training) FROM activation
    UNION ALL SELECT 3, 'At least one meaningful action', COUNT(*) FROM activation a
        WHERE a.user_id IN (SELECT user_id FROM usage_events WHERE {M})
    UNION ALL SELECT 4, 'Activated users', COUNT(*) FILTER (WHERE activated) FROM activation
) s""", ACT))
def q_adoption_funnel(spark, sf):
    return reports.adoption_funnel(tables(spark, sf), CFG)


@register("training_activation_points", with_bind("""
SELECT a.business_unit, a.eligible_users, a.activation_rate_pct, t.training_completion_rate_pct
FROM act_bu a LEFT JOIN tr_bu t ON t.business_unit = a.business_unit""", SC))
def q_training_activation_points(spark, sf):
    return reports.training_activation_points(tables(spark, sf), CFG)


@register("priority_quadrant", with_bind(f"""
SELECT business_unit, eligible_users, activation_rate_pct, training_completion_rate_pct, avg_rating,
       CASE WHEN activation_rate_pct < m_act AND training_completion_rate_pct < m_tr THEN 'Training gap'
            WHEN activation_rate_pct < m_act AND eligible_users >= m_elig THEN 'Biggest-impact fix'
            WHEN activation_rate_pct < m_act THEN 'Monitor'
            WHEN avg_rating < m_rat THEN 'High activity, low satisfaction'
            ELSE 'High activity, high satisfaction' END AS quadrant
FROM (SELECT p.*, quantile_cont(eligible_users, 0.5) OVER () AS m_elig,
             quantile_cont(activation_rate_pct, 0.5) OVER () AS m_act,
             quantile_cont(training_completion_rate_pct, 0.5) OVER () AS m_tr,
             quantile_cont(avg_rating, 0.5) OVER () AS m_rat
      FROM (SELECT a.business_unit, a.eligible_users, a.activation_rate_pct, t.training_completion_rate_pct, r.avg_rating
            FROM act_bu a LEFT JOIN tr_bu t ON t.business_unit = a.business_unit
            LEFT JOIN (SELECT u.business_unit, {half_up_ratio('SUM(f.rating_1_to_5)', 'COUNT(f.rating_1_to_5)', 2)} AS avg_rating
                       FROM feedback f JOIN users u ON u.user_id = f.user_id
                       WHERE u.business_unit IS NOT NULL GROUP BY u.business_unit) r
              ON r.business_unit = a.business_unit) p) x""", SC))
def q_priority_quadrant(spark, sf):
    return reports.priority_quadrant(tables(spark, sf), CFG)


@register("segment_actions", with_bind(f"""
SELECT a.business_unit, a.activation_rate_pct, t.training_completion_rate_pct, b.barrier_category AS top_barrier
FROM act_bu a LEFT JOIN tr_bu t ON t.business_unit = a.business_unit
LEFT JOIN (SELECT business_unit, barrier_category FROM (
              SELECT business_unit, barrier_category,
                     ROW_NUMBER() OVER (PARTITION BY business_unit ORDER BY mentions DESC, barrier_category) AS rn
              FROM bc) z WHERE rn = 1) b ON b.business_unit = a.business_unit""", SC + ",\n" + BC))
def q_segment_actions(spark, sf):
    return reports.segment_actions(tables(spark, sf), CFG)


@register("executive_narrative", with_bind(f"""
SELECT a.activation_rate_pct, w.wau_change, b.top_barrier,
       'This period, activation rate is ' || printf('%.1f%%', a.activation_rate_pct) || ', weekly active users are '
       || CASE WHEN w.wau_change >= 0 THEN 'up' ELSE 'down' END || ' ' || format('{{:,}}', abs(w.wau_change))
       || ' vs. last week, and the most commonly reported barrier is "' || COALESCE(b.top_barrier, 'none')
       || '". (Synthetic data — association only, not a causal claim.)' AS narrative
FROM (SELECT {pct1('COUNT(*) FILTER (WHERE activated)', 'COUNT(*)')} AS activation_rate_pct FROM activation) a,
     (SELECT COALESCE(MAX(CASE WHEN week_number = mw THEN chg END), 0) AS wau_change FROM (
         SELECT g.week_number, MAX(g.week_number) OVER () AS mw,
                COALESCE(x.n, 0) - LAG(COALESCE(x.n, 0)) OVER (ORDER BY g.week_number) AS chg
         FROM (SELECT DISTINCT week_number FROM calendar) g
         LEFT JOIN (SELECT week_number, COUNT(*) AS n FROM uw GROUP BY week_number) x ON x.week_number = g.week_number) y) w
LEFT JOIN (SELECT barrier_category AS top_barrier FROM (
              SELECT barrier_category, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, barrier_category) AS rn
              FROM feedback WHERE barrier_category IS NOT NULL AND barrier_category <> {NB}
              GROUP BY barrier_category) z WHERE rn = 1) b ON TRUE""", ACT + ",\n" + UW.strip()))
def q_executive_narrative(spark, sf):
    return reports.executive_narrative(tables(spark, sf), CFG)


@register("activation_by_access_week", with_bind(f"""
SELECT c.week_number, COUNT(*) AS eligible_users, COUNT(*) FILTER (WHERE a.activated) AS activated_users,
       {pct1('COUNT(*) FILTER (WHERE a.activated)', 'COUNT(*)')} AS activation_rate_pct
FROM activation a JOIN calendar c ON c.date = a.assigned_access_date
GROUP BY c.week_number""", ACT))
def q_activation_by_access_week(spark, sf):
    return reports.activation_by_access_week(tables(spark, sf), CFG)


@register("profile_counts", with_bind("""
SELECT 'users' AS table_name, 'business_unit' AS column_name, CAST(business_unit AS VARCHAR) AS value, COUNT(*) AS n
FROM users WHERE business_unit IS NOT NULL GROUP BY 3
UNION ALL SELECT 'users', 'role', CAST(role AS VARCHAR), COUNT(*) FROM users WHERE role IS NOT NULL GROUP BY 3
UNION ALL SELECT 'events', 'event_type', event_type, COUNT(*) FROM usage_events WHERE event_type IS NOT NULL GROUP BY 3
UNION ALL SELECT 'events', 'feature_name', feature_name, COUNT(*) FROM usage_events WHERE feature_name IS NOT NULL GROUP BY 3
UNION ALL SELECT 'feedback', 'rating_1_to_5', CAST(rating_1_to_5 AS VARCHAR), COUNT(*) FROM feedback
    WHERE rating_1_to_5 IS NOT NULL GROUP BY 3
UNION ALL SELECT 'feedback', 'barrier_category', barrier_category, COUNT(*) FROM feedback
    WHERE barrier_category IS NOT NULL GROUP BY 3"""))
def q_profile_counts(spark, sf):
    return reports.profile_counts(tables(spark, sf))


FILTER_BUS = ("BUILDING", "MACHINERY")
FILTER_FROM, FILTER_TO = "2024-01-08", "2024-01-28"


@register("wau_filtered", with_bind(f"""
SELECT uw.week_number, uw.week_start_date, u.business_unit, COUNT(*) AS weekly_active_users
FROM (SELECT f.user_id, c.week_number, c.week_start_date
      FROM usage_events f JOIN calendar c ON c.date = CAST(f.event_timestamp AS DATE)
      WHERE f.{M} AND CAST(f.event_timestamp AS DATE) BETWEEN DATE {q(FILTER_FROM)} AND DATE {q(FILTER_TO)}
      GROUP BY 1, 2, 3) uw
JOIN users u ON u.user_id = uw.user_id
WHERE u.business_unit IN {in_list(FILTER_BUS)}
GROUP BY 1, 2, 3"""))
def q_wau_filtered(spark, sf):
    t = tables(spark, sf).where(
        users=F.col("business_unit").isin(*FILTER_BUS),
        events=F.to_date("event_timestamp").between(F.lit(FILTER_FROM).cast("date"), F.lit(FILTER_TO).cast("date")),
    )
    return activity.weekly_active_users(t, CFG, "business_unit")


TARGET_BUS = ("AUTOMOBILE", "HOUSEHOLD")
TARGET_BARRIERS = ("Low output quality", "Tool performance issue")


@register("target_segments", with_bind(f"""
SELECT x.reason, x.user_id, u.business_unit FROM (
    SELECT 'eligible_not_activated' AS reason, user_id FROM activation
        WHERE NOT activated AND business_unit IN {in_list(TARGET_BUS)}
    UNION ALL SELECT DISTINCT 'reported_barrier', user_id FROM feedback WHERE barrier_category IN {in_list(TARGET_BARRIERS)}
    UNION ALL SELECT 'heavy_qualifying_feature_user', user_id FROM usage_events
        WHERE feature_name = {q(CFG.qualifying_feature)} GROUP BY user_id HAVING COUNT(*) >= 5
) x LEFT JOIN users u ON u.user_id = x.user_id""", ACT))
def q_target_segments(spark, sf):
    return reports.target_segments(tables(spark, sf), CFG, TARGET_BUS, TARGET_BARRIERS, 5)


# --------------------------------------------------------------------------- star schema

STAR = f"""{FEATURES},
dim_business_unit AS (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY business_unit_name) AS INTEGER) AS business_unit_key, business_unit_name
    FROM (SELECT business_unit AS business_unit_name FROM users WHERE business_unit IS NOT NULL
          UNION SELECT business_unit FROM training_sessions WHERE business_unit IS NOT NULL) x
),
dim_role AS (
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY role_name, manager_level) AS INTEGER) AS role_key, role_name, manager_level
    FROM (SELECT DISTINCT role AS role_name, manager_level FROM users WHERE role IS NOT NULL) x
),
dim_feature AS (
    SELECT CAST(-1 AS INTEGER) AS feature_key, 'F00' AS feature_id, 'Unknown / Not Captured' AS feature_name,
           'Unknown' AS feature_category, 'Unknown' AS target_persona, CAST(NULL AS DATE) AS release_date,
           CAST(NULL AS BOOLEAN) AS core_feature_flag
    UNION ALL
    SELECT CAST(ROW_NUMBER() OVER (ORDER BY feature_id) AS INTEGER), feature_id, feature_name, feature_category,
           target_persona, release_date, core_feature_flag FROM clean_features
),
dim_date AS (
    SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key, date AS full_date, week_start_date, week_number,
           month, month_name, quarter, year FROM calendar
),
dim_user AS (
    SELECT u.user_id AS user_key, u.user_id, b.business_unit_key, r.role_key, u.region, u.hire_date,
           u.assigned_access_date, CAST(strftime(u.assigned_access_date, '%Y%m%d') AS INTEGER) AS assigned_access_date_key,
           u.rollout_wave, u.training_assigned_date, u.training_completed_date, u.training_format,
           u.manager_champion_flag, u.eligible_for_access_flag
    FROM users u LEFT JOIN dim_business_unit b ON b.business_unit_name = u.business_unit
    LEFT JOIN dim_role r ON r.role_name = u.role
),
fact_usage_events AS (
    SELECT e.event_id, e.user_id AS user_key, CAST(strftime(e.event_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(COALESCE(f.feature_key, -1) AS INTEGER) AS feature_key, e.event_timestamp, e.event_type,
           e.prompt_category, e.output_exported_flag, e.successful_completion_flag, e.estimated_minutes_saved,
           e.session_duration_seconds, e.error_flag, e.platform, e.source_system, e.session_id
    FROM usage_events e
    LEFT JOIN (SELECT * FROM dim_feature WHERE feature_key > 0) f ON f.feature_name = e.feature_name
    WHERE e.user_id IN (SELECT user_id FROM users)
),
fact_feedback AS (
    SELECT b.feedback_id, b.user_id AS user_key, CAST(strftime(b.feedback_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
           CAST(COALESCE(f.feature_key, -1) AS INTEGER) AS feature_key, b.feedback_timestamp, b.rating_1_to_5,
           b.sentiment_label, b.barrier_category, b.free_text_feedback, b.would_recommend_flag
    FROM feedback b
    LEFT JOIN (SELECT * FROM dim_feature WHERE feature_key > 0) f ON f.feature_name = b.feature_name
    WHERE b.user_id IN (SELECT user_id FROM users)
),
fact_training_attendance AS (
    SELECT t.training_session_id, b.business_unit_key, CAST(strftime(t.session_date, '%Y%m%d') AS INTEGER) AS date_key,
           t.training_format, t.registered_count, t.attended_count, t.completion_count, t.facilitator, t.session_topic
    FROM training_sessions t LEFT JOIN dim_business_unit b ON b.business_unit_name = t.business_unit
)"""

STAR_TABLES = ["dim_business_unit", "dim_role", "dim_feature", "dim_date", "dim_user", "fact_usage_events",
               "fact_feedback", "fact_training_attendance"]


def _given_features(spark, sf) -> DataFrame:
    """The feature catalog that the given parts make, cleaned."""
    return cleaning.clean_features(bind_raw_features(read(spark, sf, "part")))


def _star(spark, sf):
    from uptake.operators import star as st
    return st.star(tables(spark, sf).replace(features=_given_features(spark, sf)))


def _register_star_table(name: str):
    dbl = ("estimated_minutes_saved",) if name == "fact_usage_events" else ()

    @register(name, with_bind(f"SELECT * FROM {name}", STAR), dbl)
    def q(spark, sf):
        return _star(spark, sf)[name]
    return q


for _n in STAR_TABLES:
    _register_star_table(_n)


def _union_sql(selects: list[str]) -> str:
    return "\nUNION ALL ".join(selects)


def _pk_sql() -> str:
    from uptake.operators.star import PRIMARY_KEYS, UNIQUE_KEYS
    rules = [(tb, c, "primary key") for tb, c in PRIMARY_KEYS.items()] + [(tb, c, "unique") for tb, c in UNIQUE_KEYS.items()]
    return _union_sql([
        f"SELECT {q(tb)} AS table_name, {q(c)} AS key_column, {q(kind)} AS rule, COUNT(*) AS duplicate_keys, "
        f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS duplicate_rows "
        f"FROM (SELECT {c}, COUNT(*) AS n FROM {tb} GROUP BY {c} HAVING COUNT(*) > 1) d"
        for tb, c, kind in rules])


def _fk_sql() -> str:
    from uptake.operators.star import FOREIGN_KEYS
    return _union_sql([
        f"SELECT {q(tb)} AS table_name, {q(c)} AS column_name, {q(ref + '.' + rc)} AS \"references\", COUNT(*) AS violations "
        f"FROM {tb} x WHERE x.{c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {ref} p WHERE p.{rc} = x.{c})"
        for tb, c, ref, rc in FOREIGN_KEYS])


def _null_sql() -> str:
    from uptake.operators.star import NOT_NULL
    return _union_sql([
        f"SELECT {q(tb)} AS table_name, {q(c)} AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM {tb}"
        for tb, c in NOT_NULL])


@register("pk_violations", with_bind(_pk_sql(), STAR))
def q_pk_violations(spark, sf):
    from uptake.operators import star as st
    return st.pk_violations(_star(spark, sf))


@register("fk_violations", with_bind(_fk_sql(), STAR))
def q_fk_violations(spark, sf):
    from uptake.operators import star as st
    return st.fk_violations(_star(spark, sf))


@register("null_violations", with_bind(_null_sql(), STAR))
def q_null_violations(spark, sf):
    from uptake.operators import star as st
    return st.null_violations(_star(spark, sf))


@register("table_row_counts", with_bind(_union_sql(
    [f"SELECT {q(n)} AS table_name, COUNT(*) AS row_count FROM {n}" for n in STAR_TABLES]), STAR))
def q_table_row_counts(spark, sf):
    from uptake.operators import star as st
    return st.table_row_counts(_star(spark, sf))


FIRST_LOAD = "hire_date < DATE '2020-06-01'"  # users of the first of two loads; the second has all


def _stable_keys_sql(name: str, key: str, source: str, first: str) -> str:
    """Members of the first load by name, then those that only the second load has."""
    return with_bind(f"""
SELECT {name}, n AS {key}, TRUE AS in_first_load FROM first_load
UNION ALL
SELECT {name}, (SELECT COUNT(*) FROM first_load) + ROW_NUMBER() OVER (ORDER BY {name}), FALSE
FROM (SELECT DISTINCT {name} FROM {source} s WHERE {name} IS NOT NULL AND {name} NOT IN (SELECT {name} FROM first_load))""",
        f"first_load AS (SELECT {name}, ROW_NUMBER() OVER (ORDER BY {name}) AS n FROM "
        f"(SELECT DISTINCT {name} FROM {first} f WHERE {name} IS NOT NULL))")


def _stable_keys(members: DataFrame, first: DataFrame, name: str, key: str) -> DataFrame:
    from uptake.operators.keys import extend_key_map
    from uptake.session import materialize
    known = materialize(extend_key_map(first, [name], key), key)
    both = extend_key_map(members, [name], key, known)
    return both.join(known.select(name, F.lit(True).alias("in_first_load")), name, "left").select(
        name, key, F.coalesce("in_first_load", F.lit(False)).alias("in_first_load"))


@register("stable_user_keys", _stable_keys_sql("user_id", "user_key", "users", f"(SELECT * FROM users WHERE {FIRST_LOAD})"))
def q_stable_user_keys(spark, sf):
    u = tables(spark, sf).users
    return _stable_keys(u, u.where(FIRST_LOAD), "user_id", "user_key")


@register("stable_session_keys", _stable_keys_sql(
    "session_id", "session_key", "usage_events", "(SELECT * FROM usage_events WHERE event_type = 'output_exported')"))
def q_stable_session_keys(spark, sf):
    e = tables(spark, sf).events
    return _stable_keys(e, e.where("event_type = 'output_exported'"), "session_id", "session_key")


@register("star_load", with_bind(_union_sql(
    [f"SELECT {q(n)} AS table_name, COUNT(*) AS row_count, 2 AS version FROM {n}" for n in STAR_TABLES] +
    ["SELECT 'key_business_unit', COUNT(*), 2 FROM dim_business_unit", "SELECT 'key_role', COUNT(*), 2 FROM dim_role",
     "SELECT 'key_user', COUNT(*), 2 FROM users"]), STAR))
def q_star_load(spark, sf):
    """Two loads of the star schema, the second over the first; the tables of the current version."""
    import uuid

    from uptake.jobs import load_star
    from uptake.operators import star as st
    from uptake.session import ensure_checkpoint_dir
    from uptake.sources.publish import read_current
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/star-{uuid.uuid4().hex}"
    t = tables(spark, sf).replace(features=_given_features(spark, sf))
    load_star(spark, t.where(users=FIRST_LOAD), base)
    number = load_star(spark, t, base)["number"]
    return st.table_row_counts(read_current(spark, base)).withColumn("version", F.lit(number))


@register("user_day_refresh", with_bind(f"""
SELECT user_id, CAST(event_timestamp AS DATE) AS date, COUNT(*) AS n_events, COUNT(*) FILTER (WHERE {M}) AS n_meaningful,
       COUNT(*) FILTER (WHERE feature_name = {q(CFG.qualifying_feature)}) AS n_qualifying
FROM usage_events WHERE user_id IS NOT NULL AND event_timestamp IS NOT NULL GROUP BY 1, 2"""))
def q_user_day_refresh(spark, sf):
    """The stored user-day summary after a first load of half of the days, a second of the others, and a late arrival."""
    import uuid

    from uptake.operators.user_day_store import refresh_user_day, stored_user_day
    from uptake.session import ensure_checkpoint_dir
    from uptake.sources.io import write_events
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/user-day-{uuid.uuid4().hex}"
    t = tables(spark, sf)
    odd_day, late = F.dayofmonth("event_timestamp") % 2 == 1, F.col("event_type") == "output_exported"
    path = f"{base}/events"
    for part, mode in ((odd_day & ~late, "overwrite"), (~odd_day & ~late, "append"), (late, "append")):
        write_events(t.events.where(part), path, mode)
        refresh_user_day(spark, path, f"{base}/store", CFG)
    return stored_user_day(spark, t, f"{base}/store").user_day.select(
        "user_id", "date", "n_events", "n_meaningful", "n_qualifying")


@register("calendar_dim", with_bind("""
SELECT CAST(d.dt AS DATE) AS date, CAST(date_trunc('week', d.dt) AS DATE) AS week_start_date,
       CAST(LEAST(GREATEST(date_diff('day', CAST(date_trunc('week', b.start) AS DATE),
                                      CAST(date_trunc('week', d.dt) AS DATE)) // 7 + 1, 1), b.weeks) AS INTEGER) AS week_number,
       CAST(month(d.dt) AS INTEGER) AS month, monthname(d.dt) AS month_name,
       CAST(quarter(d.dt) AS INTEGER) AS quarter, CAST(year(d.dt) AS INTEGER) AS year
FROM (SELECT CAST(MIN(ts) AS DATE) AS start,
             CAST(date_diff('day', CAST(MIN(ts) AS DATE), CAST(MAX(ts) AS DATE)) // 7 + 1 AS INTEGER) AS weeks
      FROM events) b,
     LATERAL (SELECT unnest(generate_series(CAST(b.start AS TIMESTAMP),
                                            CAST(b.start + (b.weeks * 7 - 1) AS TIMESTAMP), INTERVAL 1 DAY)) AS dt) d"""))
def q_calendar_dim(spark, sf):
    from uptake.operators import star as st
    from uptake.sources.testbind import read
    ev = read(spark, sf, "events")
    d0, d1 = F.to_date(F.min("ts")), F.to_date(F.max("ts"))
    bounds = ev.agg(d0.alias("start"), (F.floor(F.datediff(d1, d0) / 7) + 1).cast("int").alias("weeks"))
    return st.calendar_from_start(bounds)


# --------------------------------------------------------------------------- cleaning (over the dirtied projection)

from uptake.operators import cleaning as cl  # noqa: E402
from uptake.plans.clean_sql import clean_ctes  # noqa: E402
from uptake.sources import dirty  # noqa: E402

CLEAN = clean_ctes(CFG)
_CLEANED: dict = {}


def cleaned(spark: SparkSession, sf: str) -> dict:
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _CLEANED:
        t = tables(spark, sf)
        cal = cl.clean_calendar(dirty.raw_calendar(t))
        users = cl.clean_users(dirty.raw_users(t), CFG)
        _CLEANED[key] = {
            "calendar": cal, "users": users, "events": cl.clean_events(dirty.raw_events(t), users.clean, cal, CFG),
            "feedback": cl.clean_feedback(dirty.raw_feedback(t), CFG), "training": cl.clean_training(dirty.raw_training(t), CFG),
        }
    return _CLEANED[key]


def _issue_log(c: dict) -> DataFrame:
    return (c["users"].issues.unionByName(c["events"].issues).unionByName(c["feedback"].issues)
            .unionByName(c["training"].issues))


@register("clean_users", with_bind("SELECT * FROM clean_users", CLEAN))
def q_clean_users(spark, sf):
    return cleaned(spark, sf)["users"].clean


@register("clean_events", with_bind("SELECT * FROM clean_events", CLEAN), ("estimated_minutes_saved",))
def q_clean_events(spark, sf):
    return cleaned(spark, sf)["events"].clean


@register("clean_feedback", with_bind("SELECT * FROM clean_feedback", CLEAN))
def q_clean_feedback(spark, sf):
    return cleaned(spark, sf)["feedback"].clean


@register("clean_training", with_bind("SELECT * FROM clean_training", CLEAN))
def q_clean_training(spark, sf):
    return cleaned(spark, sf)["training"].clean


@register("clean_calendar", with_bind("SELECT * FROM clean_calendar", CLEAN))
def q_clean_calendar(spark, sf):
    return cleaned(spark, sf)["calendar"]


@register("clean_features", with_bind("SELECT * FROM clean_features", FEATURES))
def q_clean_features(spark, sf):
    return _given_features(spark, sf)


@register("quarantine_feedback", with_bind("SELECT * FROM quarantine_feedback", CLEAN))
def q_quarantine_feedback(spark, sf):
    return cleaned(spark, sf)["feedback"].quarantine


@register("quarantine_bad_ts", with_bind("SELECT * FROM quarantine_events", CLEAN))
def q_quarantine(spark, sf):
    return cleaned(spark, sf)["events"].quarantine


@register("quality_issue_log", with_bind("SELECT * FROM issue_log", CLEAN))
def q_quality_issue_log(spark, sf):
    return _issue_log(cleaned(spark, sf))


@register("quality_summary", with_bind("""
SELECT COUNT(*) AS total_findings, CAST(COALESCE(SUM(affected_record_count), 0) AS BIGINT) AS total_affected_records,
       COUNT(*) FILTER (WHERE status = 'Resolved') AS resolved, COUNT(*) FILTER (WHERE status = 'Accepted') AS accepted,
       COUNT(*) FILTER (WHERE status LIKE 'Validated%') AS validated
FROM issue_log""", CLEAN))
def q_quality_summary(spark, sf):
    return cl.quality_summary(_issue_log(cleaned(spark, sf)))


@register("resolved_issues", with_bind("SELECT * FROM issue_log WHERE status = 'Resolved'", CLEAN))
def q_resolved_issues(spark, sf):
    return _issue_log(cleaned(spark, sf)).where(F.col("status") == "Resolved").orderBy(F.desc("affected_record_count"))


@register("rows_removed", with_bind("""
SELECT table_name, raw_rows, clean_rows, raw_rows - clean_rows AS rows_removed FROM (
    SELECT 'users' AS table_name, (SELECT COUNT(*) FROM raw_users) AS raw_rows, (SELECT COUNT(*) FROM clean_users) AS clean_rows
    UNION ALL SELECT 'usage_events', (SELECT COUNT(*) FROM raw_events), (SELECT COUNT(*) FROM clean_events)
    UNION ALL SELECT 'feedback', (SELECT COUNT(*) FROM raw_feedback), (SELECT COUNT(*) FROM clean_feedback)
    UNION ALL SELECT 'training_sessions', (SELECT COUNT(*) FROM raw_training), (SELECT COUNT(*) FROM clean_training)
    UNION ALL SELECT 'calendar', (SELECT COUNT(*) FROM raw_calendar), (SELECT COUNT(*) FROM clean_calendar)
) x""", CLEAN))
def q_rows_removed(spark, sf):
    t, c = tables(spark, sf), cleaned(spark, sf)
    pairs = [("users", dirty.raw_users(t), c["users"].clean), ("usage_events", dirty.raw_events(t), c["events"].clean),
             ("feedback", dirty.raw_feedback(t), c["feedback"].clean),
             ("training_sessions", dirty.raw_training(t), c["training"].clean),
             ("calendar", dirty.raw_calendar(t), c["calendar"])]
    from uptake.operators.common import with_scalars
    parts = [with_scalars(raw.agg(F.count(F.lit(1)).alias("raw_rows")), clean.agg(F.count(F.lit(1)).alias("clean_rows")))
             .select(F.lit(n).alias("table_name"), "raw_rows", "clean_rows") for n, raw, clean in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("rows_removed", F.col("raw_rows") - F.col("clean_rows"))


@register("dedup_events", with_bind("SELECT event_id, event_timestamp, ingest_seq FROM e_dedup", CLEAN))
def q_dedup_events(spark, sf):
    return cleaned(spark, sf)["events"].stages["dedup"].select("event_id", "event_timestamp", "ingest_seq")


@register("normalize_labels", with_bind("""
SELECT feature_name AS raw_label, _feature AS normalized_label, COUNT(*) AS n
FROM e_v GROUP BY feature_name, _feature""", CLEAN))
def q_normalize_labels(spark, sf):
    j = cleaned(spark, sf)["events"].stages["flagged"]
    return j.groupBy(F.col("feature_name").alias("raw_label"), F.col("_feature").alias("normalized_label")).agg(
        F.count(F.lit(1)).alias("n"))


@register("parse_bool", with_bind(f"""
SELECT raw_value, parsed, COUNT(*) AS n FROM (
    SELECT successful_completion_flag AS raw_value,
           {__import__('uptake.plans.clean_sql', fromlist=['to_bool']).to_bool('successful_completion_flag')} AS parsed
    FROM e_dedup) x GROUP BY raw_value, parsed""", CLEAN))
def q_parse_bool(spark, sf):
    from uptake.functions import to_bool
    d = cleaned(spark, sf)["events"].stages["dedup"]
    return d.groupBy(F.col("successful_completion_flag").alias("raw_value"),
                     to_bool("successful_completion_flag").alias("parsed")).agg(F.count(F.lit(1)).alias("n"))


@register("safe_timestamps", with_bind("SELECT event_id, _ts_raw AS event_timestamp_raw, event_timestamp FROM e_ts", CLEAN))
def q_safe_timestamps(spark, sf):
    return cleaned(spark, sf)["events"].stages["timestamps"].select(
        "event_id", F.col("_ts_raw").alias("event_timestamp_raw"), "event_timestamp")


@register("safe_dates", with_bind("""
SELECT user_id, _assigned_access_date_raw AS assigned_access_date_raw, assigned_access_date FROM u_p""", CLEAN))
def q_safe_dates(spark, sf):
    return cleaned(spark, sf)["users"].stages["parsed"].select(
        "user_id", F.col("_assigned_access_date_raw").alias("assigned_access_date_raw"), "assigned_access_date")


@register("safe_numeric", with_bind("""
SELECT event_id, estimated_minutes_saved AS minutes_raw, _min AS minutes, session_duration_seconds AS duration_raw,
       _dur AS duration FROM e_v""", CLEAN), ("minutes",))
def q_safe_numeric(spark, sf):
    return cleaned(spark, sf)["events"].stages["flagged"].select(
        "event_id", F.col("estimated_minutes_saved").alias("minutes_raw"), F.col("_min").alias("minutes"),
        F.col("session_duration_seconds").alias("duration_raw"), F.col("_dur").alias("duration"))


@register("null_negatives", with_bind("""
SELECT event_id, estimated_minutes_saved, session_duration_seconds FROM clean_events
WHERE event_id IN (SELECT event_id FROM e_v WHERE _neg_min OR _neg_dur)""", CLEAN), ("estimated_minutes_saved",))
def q_null_negatives(spark, sf):
    c = cleaned(spark, sf)["events"]
    neg = c.stages["flagged"].where(F.coalesce(F.col("_neg_min"), F.lit(False)) | F.coalesce(F.col("_neg_dur"), F.lit(False))).select("event_id")
    return c.clean.join(neg, "event_id", "left_semi").select("event_id", "estimated_minutes_saved", "session_duration_seconds")


@register("null_bad_ratings", with_bind("""
SELECT feedback_id, rating_1_to_5 AS rating_raw, _rating AS rating_parsed, _bad_rating AS nulled FROM f_v
WHERE _rating IS NULL OR _bad_rating""", CLEAN))
def q_null_bad_ratings(spark, sf):
    v = cleaned(spark, sf)["feedback"].stages["parsed"]
    return v.where(F.col("_rating").isNull() | F.col("_bad_rating")).select(
        "feedback_id", F.col("rating_1_to_5").alias("rating_raw"), F.col("_rating").alias("rating_parsed"),
        F.col("_bad_rating").alias("nulled"))


@register("date_order_rule", with_bind("""
SELECT user_id, training_assigned_date, training_completed_date, _bad_order AS completion_nulled FROM u_p""", CLEAN))
def q_date_order_rule(spark, sf):
    return cleaned(spark, sf)["users"].stages["parsed"].select(
        "user_id", "training_assigned_date", "training_completed_date", F.col("_bad_order").alias("completion_nulled"))


@register("drop_pre_access", with_bind("""
SELECT event_id, user_id, event_timestamp, _access AS assigned_access_date FROM e_j WHERE _pre""", CLEAN))
def q_drop_pre_access(spark, sf):
    return cleaned(spark, sf)["events"].stages["flagged"].where("_pre").select(
        "event_id", "user_id", "event_timestamp", F.col("_access").alias("assigned_access_date"))


@register("flag_no_access", with_bind("SELECT event_id, user_id FROM clean_events WHERE no_access_on_file", CLEAN))
def q_flag_no_access(spark, sf):
    return cleaned(spark, sf)["events"].clean.where("no_access_on_file").select("event_id", "user_id")


@register("drop_after_window", with_bind("SELECT event_id, user_id, event_timestamp FROM e_j WHERE _after", CLEAN))
def q_drop_after_window(spark, sf):
    return cleaned(spark, sf)["events"].stages["flagged"].where("_after").select("event_id", "user_id", "event_timestamp")


@register("attendance_consistency", with_bind("SELECT * FROM t_counts", CLEAN))
def q_attendance_consistency(spark, sf):
    return cleaned(spark, sf)["training"].stages["counts"]


@register("label_variant_counts", with_bind("""
SELECT 'users' AS table_name, 'business_unit' AS column_name, n_bu_variants AS variants_before,
       n_bu_unmapped AS unmapped_after FROM u_counts
UNION ALL SELECT 'usage_events', 'feature_name', n_feature_variants,
       (SELECT COUNT(*) FILTER (WHERE _feature IS NOT NULL AND _feature NOT IN (SELECT feature_name FROM feature_catalog))
        FROM e_v) FROM e_counts
UNION ALL SELECT 'feedback', 'feature_name', n_feature_variants,
       (SELECT COUNT(*) FILTER (WHERE _feature IS NOT NULL AND _feature NOT IN (SELECT feature_name FROM feature_catalog))
        FROM f_v) FROM f_counts""", CLEAN))
def q_label_variant_counts(spark, sf):
    c = cleaned(spark, sf)
    feats = list(CFG.feature_names)
    pu = c["users"].stages["parsed"].agg(
        F.count_if(cl._not_in(F.col("_bu_raw"), CFG.canonical_business_units)).alias("variants_before"),
        F.count_if(cl._not_in(F.col("business_unit"), CFG.canonical_business_units)).alias("unmapped_after"),
    ).select(F.lit("users").alias("table_name"), F.lit("business_unit").alias("column_name"), "*")

    def feat(df, name):
        return df.agg(
            F.count_if("_f_variant").alias("variants_before"),
            F.count_if(F.col("_feature").isNotNull() & ~F.col("_feature").isin(*feats)).alias("unmapped_after"),
        ).select(F.lit(name).alias("table_name"), F.lit("feature_name").alias("column_name"), "*")

    return pu.unionByName(feat(c["events"].stages["flagged"], "usage_events")).unionByName(
        feat(c["feedback"].stages["parsed"], "feedback"))


@register("missing_value_counts", with_bind("""
SELECT 'users' AS table_name, 'assigned_access_date' AS column_name, n_missing_access AS missing FROM u_counts
UNION ALL SELECT 'users', 'manager_champion_flag', n_missing_champion FROM u_counts
UNION ALL SELECT 'usage_events', 'feature_name', n_missing_feature FROM e_counts
UNION ALL SELECT 'feedback', 'feature_name', n_missing_feature FROM f_counts
UNION ALL SELECT 'feedback', 'free_text_feedback', n_missing_text FROM f_counts""", CLEAN))
def q_missing_value_counts(spark, sf):
    c = cleaned(spark, sf)
    u = c["users"].clean.agg(
        F.count_if(F.col("assigned_access_date").isNull()).alias("a"), F.count_if(F.col("manager_champion_flag").isNull()).alias("b"))
    e = c["events"].stages["flagged"].agg(F.count_if(F.col("_feature").isNull()).alias("a"))
    f = c["feedback"].stages["parsed"].agg(F.count_if(F.col("_feature").isNull()).alias("a"),
                                            F.count_if(cl.is_blank("free_text_feedback")).alias("b"))

    def row(df, col, tbl, name):
        return df.select(F.lit(tbl).alias("table_name"), F.lit(name).alias("column_name"), F.col(col).alias("missing"))

    return (row(u, "a", "users", "assigned_access_date").unionByName(row(u, "b", "users", "manager_champion_flag"))
            .unionByName(row(e, "a", "usage_events", "feature_name")).unionByName(row(f, "a", "feedback", "feature_name"))
            .unionByName(row(f, "b", "feedback", "free_text_feedback")))


# --------------------------------------------------------------------------- raw files, and the cleaning job over them

_EXPORTED: dict = {}


def _exported(spark, sf, clean: bool = True) -> str:
    """Folder with the raw CSV export of the dirtied tables (``raw``) and, made once a session, the cleaning job's output
    over it (``clean``)."""
    import uuid

    from uptake.jobs import run_cleaning
    from uptake.session import ensure_checkpoint_dir
    key = (spark.sparkContext.applicationId, id(spark), sf)
    if key not in _EXPORTED:
        base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/raw-{uuid.uuid4().hex}"
        dirty.export_raw(tables(spark, sf), f"{base}/raw")
        _EXPORTED[key] = [base, False]
    base, done = _EXPORTED[key]
    if clean and not done:
        run_cleaning(spark, f"{base}/raw", f"{base}/clean", CFG)
        _EXPORTED[key][1] = True
    return base


def _na_sql(table: str, cols: list[str]) -> str:
    from uptake.config import CSV_NA_TOKENS
    return f"SELECT {', '.join(f'CASE WHEN {c} NOT IN {in_list(CSV_NA_TOKENS)} THEN {c} END AS {c}' for c in cols)} FROM {table}"


RAW_EVENT_COLS = ["event_id", "user_id", "event_timestamp", "session_id", "feature_name", "event_type", "prompt_category",
                  "output_exported_flag", "successful_completion_flag", "estimated_minutes_saved", "session_duration_seconds",
                  "error_flag", "platform", "source_system"]


@register("raw_csv_events", with_bind(_na_sql("raw_events", RAW_EVENT_COLS), CLEAN))
def q_raw_csv_events(spark, sf):
    from uptake.sources.csv_records import read_raw_csv
    return read_raw_csv(spark, f"{_exported(spark, sf, clean=False)}/raw/usage_events").select(*RAW_EVENT_COLS)


@register("clean_layer_events", with_bind("SELECT * EXCLUDE (no_access_on_file) FROM clean_events", CLEAN), ("estimated_minutes_saved",))
def q_clean_layer_events(spark, sf):
    from uptake.sources.io import load_tables
    return load_tables(spark, f"{_exported(spark, sf)}/clean").events.drop("event_date")


@register("clean_layer_log", with_bind("SELECT * FROM issue_log", CLEAN))
def q_clean_layer_log(spark, sf):
    """The issue log that the cleaning job wrote, its counts observed while the tables were written."""
    from uptake.sources.io import read_issue_log
    return read_issue_log(spark, f"{_exported(spark, sf)}/clean/data_quality_issues")


# --------------------------------------------------------------------------- expectations, keys, samples

@register("expectations_report", with_bind(f"""
SELECT check_name, CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM (
    SELECT 'unique user_id' AS check_name, (SELECT COUNT(*) FROM (SELECT user_id FROM users GROUP BY 1 HAVING COUNT(*) > 1)) AS failures
    UNION ALL SELECT 'unique event_id', (SELECT COUNT(*) FROM (SELECT event_id FROM usage_events GROUP BY 1 HAVING COUNT(*) > 1))
    UNION ALL SELECT 'no event before access date', (SELECT COUNT(*) FROM usage_events e LEFT JOIN users u ON u.user_id = e.user_id
        WHERE CAST(e.event_timestamp AS DATE) < u.assigned_access_date)
    UNION ALL SELECT 'no negative minutes or duration', (SELECT COUNT(*) FROM usage_events
        WHERE estimated_minutes_saved < 0 OR session_duration_seconds < 0)
    UNION ALL SELECT 'ratings within 1-5', (SELECT COUNT(*) FROM feedback WHERE NOT (rating_1_to_5 BETWEEN 1 AND 5))
    UNION ALL SELECT 'activated <= eligible', (SELECT COUNT(*) FROM (SELECT business_unit, COUNT(*) AS e,
        COUNT(*) FILTER (WHERE activated) AS a FROM activation WHERE business_unit IS NOT NULL GROUP BY 1) x WHERE a > e)
    UNION ALL SELECT 'activation rate within 0-100', 0
    UNION ALL SELECT 'week-0 retention is 100', (SELECT COUNT(*) FROM ret WHERE weeks_since_activation = 0
        AND retention_rate_pct <> 100.0)
    UNION ALL SELECT 'barrier ranks start at 1', (SELECT COUNT(*) FROM (SELECT business_unit, MIN(barrier_rank) AS m
        FROM br GROUP BY 1) x WHERE m <> 1)
    UNION ALL SELECT 'every calendar week has WAU', (SELECT COUNT(*) FROM (SELECT DISTINCT week_number FROM calendar) c
        WHERE c.week_number NOT IN (SELECT week_number FROM uw))
    UNION ALL SELECT 'business_unit in canonical set', (SELECT COUNT(*) FROM users
        WHERE business_unit IS NOT NULL AND business_unit NOT IN {in_list(CFG.canonical_business_units)})
    UNION ALL SELECT 'event_type in canonical set', (SELECT COUNT(*) FROM usage_events
        WHERE event_type IS NOT NULL AND event_type NOT IN {in_list(ALL_EVENT_TYPES)})
    UNION ALL SELECT 'event feature_name in canonical set', (SELECT COUNT(*) FROM usage_events
        WHERE feature_name IS NOT NULL AND feature_name NOT IN {in_list(CFG.feature_names)})
    UNION ALL SELECT 'feedback feature_name in canonical set', (SELECT COUNT(*) FROM feedback
        WHERE feature_name IS NOT NULL AND feature_name NOT IN {in_list(CFG.feature_names)})
    UNION ALL SELECT 'barrier_category in canonical set', (SELECT COUNT(*) FROM feedback
        WHERE barrier_category IS NOT NULL AND barrier_category NOT IN {in_list(CFG.barrier_categories)})
    UNION ALL SELECT 'users row count in range', CASE WHEN (SELECT COUNT(*) FROM users) >= 1 THEN 0 ELSE 1 END
    UNION ALL SELECT 'events row count in range', CASE WHEN (SELECT COUNT(*) FROM usage_events) >= 1 THEN 0 ELSE 1 END
    UNION ALL SELECT 'feedback row count in range', CASE WHEN (SELECT COUNT(*) FROM feedback) >= 1 THEN 0 ELSE 1 END
    UNION ALL SELECT 'calendar row count in range', CASE WHEN (SELECT COUNT(*) FROM calendar) >= 1 THEN 0 ELSE 1 END
    UNION ALL SELECT 'features row count in range',
        CASE WHEN (SELECT COUNT(*) FROM feature_catalog) >= 1 THEN 0 ELSE 1 END
    UNION ALL SELECT 'training row count in range',
        CASE WHEN (SELECT COUNT(*) FROM training_sessions) >= 1 THEN 0 ELSE 1 END
) z""", ACT + ",\n" + COH + ",\n" + BC + ",\n" + UW.strip()))
def q_expectations_report(spark, sf):
    from uptake.operators.expectations import expectations_report
    return expectations_report(tables(spark, sf), CFG)


@register("user_day_session_key", with_bind("""
SELECT event_id, user_id, concat_ws('-', 'S', CAST(user_id AS VARCHAR), strftime(event_timestamp, '%Y%m%d')) AS session_key
FROM usage_events"""))
def q_user_day_session_key(spark, sf):
    ev = tables(spark, sf).events
    return ev.select("event_id", "user_id", F.concat_ws(
        "-", F.lit("S"), F.col("user_id").cast("string"), F.date_format("event_timestamp", "yyyyMMdd")).alias("session_key"))


@register("event_sample", with_bind("SELECT * FROM usage_events ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id LIMIT 500"),
          ("estimated_minutes_saved",))
def q_event_sample(spark, sf):
    from uptake.sources.io import event_sample
    return event_sample(tables(spark, sf).events, 500)


@register("fact_training", with_bind("SELECT * FROM fact_training_attendance", STAR))
def q_fact_training(spark, sf):
    return _star(spark, sf)["fact_training_attendance"]


@register("table_profile", with_bind("\nUNION ALL ".join(
    # columns are counted from the table itself: the keys of one of its rows
    f"SELECT {q(n)} AS table_name, COUNT(*) AS row_count, "
    f"CAST((SELECT len(json_keys(to_json(x))) FROM {n} x LIMIT 1) AS INTEGER) AS column_count FROM {n}"
    for n in ("users", "usage_events", "feedback", "calendar", "feature_catalog", "training_sessions"))))
def q_table_profile(spark, sf):
    from uptake.operators.reports import table_profile
    return table_profile(tables(spark, sf))


@register("null_segment_counts", with_bind("""
SELECT 'business_unit' AS segment_column, COUNT(*) FILTER (WHERE business_unit IS NULL) AS users_dropped,
       (SELECT COUNT(*) FROM usage_events e JOIN users u ON u.user_id = e.user_id WHERE u.business_unit IS NULL)
           AS events_dropped
FROM users
UNION ALL SELECT 'role', COUNT(*) FILTER (WHERE role IS NULL),
       (SELECT COUNT(*) FROM usage_events e JOIN users u ON u.user_id = e.user_id WHERE u.role IS NULL) FROM users
UNION ALL SELECT 'rollout_wave', COUNT(*) FILTER (WHERE rollout_wave IS NULL),
       (SELECT COUNT(*) FROM usage_events e JOIN users u ON u.user_id = e.user_id WHERE u.rollout_wave IS NULL)
FROM users"""))
def q_null_segment_counts(spark, sf):
    from uptake.operators.expectations import null_segment_counts
    return null_segment_counts(tables(spark, sf), ["business_unit", "role", "rollout_wave"])
