"""Hand-built users with known answers, one per definitional choice (D1 ... D18)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig
from uptake.operators import activity, feedback, features, population, retention, training, value
from uptake.sources.testbind import calendar_from_bounds, feature_catalog
from uptake.tables import Tables

D = dt.date
T = dt.datetime
USERS = "user_id string, business_unit string, role string, rollout_wave int, assigned_access_date date, " \
        "training_assigned_date date, training_completed_date date, eligible_for_access_flag boolean"
EVENTS = "event_id string, user_id string, event_timestamp timestamp_ntz, feature_name string, event_type string, " \
         "successful_completion_flag boolean, estimated_minutes_saved decimal(18,2)"
FEEDBACK = "feedback_id string, user_id string, feedback_timestamp timestamp_ntz, rating_1_to_5 int, " \
           "barrier_category string, feature_name string, would_recommend_flag boolean"
CFG = AdoptionConfig(activation_window_days=14, trailing_window_days=28)


def make(spark, users, events, feedback_rows=()):
    u = spark.createDataFrame(users, USERS)
    e = spark.createDataFrame(events, EVENTS)
    f = spark.createDataFrame(list(feedback_rows), FEEDBACK)
    bounds = spark.createDataFrame([(D(2024, 1, 1), D(2024, 3, 31))], "s date, e date")
    tr = spark.createDataFrame([], "business_unit string, registered_count int, attended_count int, completion_count int")
    return Tables(users=u, events=e, feedback=f, calendar=calendar_from_bounds(bounds), features=feature_catalog(spark),
                  training=tr)


def user(uid, bu="Ops", access=D(2024, 1, 1), trained=True, eligible=True, assigned=D(2023, 12, 1)):
    return (uid, bu, "Analyst", 1, access, assigned, D(2023, 12, 20) if trained else None, eligible)


def ev(eid, uid, ts, etype="prompt_submitted", feat="Knowledge Search", ok=True, mins=None):
    return (eid, uid, ts, feat, etype, ok, Decimal(mins) if mins is not None else None)


def test_d1_activation_window_counts_whole_last_day(spark):
    users = [user("a"), user("b")]
    evs = [ev(f"a{i}", "a", T(2024, 1, 2, 9)) for i in range(2)] + [ev("a9", "a", T(2024, 1, 15, 12))]
    evs += [ev(f"b{i}", "b", T(2024, 1, 2, 9)) for i in range(2)] + [ev("b9", "b", T(2024, 1, 15, 0, 0))]
    t = make(spark, users, evs)
    date_rule = {r.user_id: r.activated for r in population.activation_users(t, CFG).collect()}
    assert date_rule == {"a": True, "b": True}
    inst = {r.user_id: r.activated for r in population.activation_users(t, CFG.with_(activation_boundary="instant")).collect()}
    assert inst == {"a": False, "b": True}  # 12:00 on day 14 is past the instant boundary; midnight is not


def test_activation_needs_training_or_qualifying_feature(spark):
    users = [user("a", trained=False), user("b", trained=False), user("c", eligible=False)]
    evs = [ev(f"a{i}", "a", T(2024, 1, 3)) for i in range(3)]
    evs += [ev(f"b{i}", "b", T(2024, 1, 3), feat="Prompt Library") for i in range(3)]
    evs += [ev(f"c{i}", "c", T(2024, 1, 3)) for i in range(3)]
    t = make(spark, users, evs)
    r = population.activation_rate(t, CFG).collect()[0]
    assert (r.eligible_users, r.activated_users, r.activation_rate_pct) == (2, 1, 50.0)


def test_d2_d3_time_to_value_population_and_fraction(spark):
    users = [user("a"), user("b", eligible=False), user("c", access=None)]
    evs = [ev("a1", "a", T(2024, 1, 1, 0, 59), "output_generated"), ev("b1", "b", T(2024, 1, 2, 6), "output_exported"),
           ev("c1", "c", T(2024, 1, 2), "output_exported"), ev("a0", "a", T(2024, 1, 1, 0, 10), "output_generated", ok=False)]
    t = make(spark, users, evs)
    got = {r.user_id: r.hours_to_value for r in value.time_to_value(t, CFG).collect()}
    assert got == {"a": pytest.approx(59 / 60), "b": pytest.approx(30.0)}
    assert {r.user_id for r in value.time_to_value(t, CFG.with_(ttv_eligible_only=True)).collect()} == {"a"}


def test_d4_two_time_saved_rules(spark):
    users = [user("a")]
    evs = [ev("1", "a", T(2024, 1, 2), "output_generated", mins="10.25"),
           ev("2", "a", T(2024, 1, 2), "prompt_submitted", mins="5.00"),           # not a value event
           ev("3", "a", T(2024, 1, 2), "output_exported", ok=False, mins="7.00"),  # failed
           ev("4", "a", T(2024, 1, 2), "output_exported", feat=None, mins="3.00"),  # unknown feature
           ev("5", "a", T(2024, 1, 2), "output_exported", feat="Meeting Notes")]
    t = make(spark, users, evs)
    by_sql = {r.feature_name: r for r in value.time_saved_by_feature(t, CFG).collect()}
    assert by_sql["Knowledge Search"].successful_actions_with_estimate == 3
    assert by_sql["Knowledge Search"].total_estimated_minutes_saved == 22.0
    assert by_sql["Meeting Notes"].successful_actions_with_estimate == 0
    assert by_sql["Meeting Notes"].total_estimated_minutes_saved is None
    by_value = {r.feature_name: r for r in value.time_saved_value_events(t, CFG).collect()}
    assert set(by_value) == {"Knowledge Search"}
    assert by_value["Knowledge Search"].total_estimated_minutes_saved == 10.3  # 10.25 rounds half up


def test_d5_d6_dormancy_as_of_and_28_dates(spark):
    users = [user("a"), user("b")]
    evs = [ev(f"a{i}", "a", T(2024, 1, 2)) for i in range(3)] + [ev("a9", "a", T(2024, 1, 31, 10))]
    evs += [ev(f"b{i}", "b", T(2024, 1, 2)) for i in range(3)] + [ev("b9", "b", T(2024, 1, 4))]
    evs += [ev("z", "b", T(2024, 3, 1, 8), etype="app_opened")]  # non-meaningful last event sets as-of (D5)
    t = make(spark, users, evs)
    r = retention.dormant_users(t, CFG, "business_unit").collect()[0]
    # as-of 2024-03-01: window is dates > 2024-02-02; a (Jan 31) and b (Jan 4) are both dormant
    assert (r.activated_users, r.dormant_users) == (2, 2)
    r2 = retention.dormant_users(t, CFG.with_(as_of_date="2024-02-27"), "business_unit").collect()[0]
    assert r2.dormant_users == 1  # Jan 31 is inside the 28 dates ending Feb 27


def test_d7_stickiness_never_exceeds_100(spark):
    users = [user("a")]
    evs = [ev("1", "a", T(2024, 1, 7, 23))]  # only the last day of week 1
    t = make(spark, users, evs)
    r = [x for x in activity.stickiness(t, CFG).collect() if x.week_number == 1][0]
    assert (r.weekly_active_users, r.monthly_active_users, r.stickiness_pct) == (1, 1, 100.0)


@pytest.mark.parametrize("start, end, ends", [
    (D(2024, 1, 1), D(2024, 1, 15), {1: D(2024, 1, 7), 2: D(2024, 1, 14), 3: D(2024, 1, 15)}),  # ends on a Monday
    (D(2024, 1, 1), D(2024, 1, 17), {1: D(2024, 1, 7), 2: D(2024, 1, 14), 3: D(2024, 1, 17)}),  # ends on a Wednesday
    (D(2024, 1, 3), D(2024, 1, 19), {1: D(2024, 1, 9), 2: D(2024, 1, 16), 3: D(2024, 1, 19)}),  # weeks begin on a Wednesday
])
def test_partial_and_shifted_weeks_keep_their_activity(spark, start, end, ends):
    evs = [ev(f"a{i}", "a", T(2024, 1, 3 + i)) for i in range(3)] + [ev("a9", "a", T(end.year, end.month, end.day, 9))]
    evs += [ev(f"b{i}", "b", T(2024, 1, 3 + i)) for i in range(3)]
    bounds = spark.createDataFrame([(start, end)], "s date, e date")
    t = make(spark, [user("a"), user("b")], evs).replace(calendar=calendar_from_bounds(bounds))
    mau = {r.week_number: (r.as_of_date, r.monthly_active_users) for r in activity.mau_by_week(t, CFG).collect()}
    assert mau == {k: (e, 2) for k, e in ends.items()}
    seven = {r.week_number: r.monthly_active_users for r in activity.mau_by_week(t, CFG.with_(trailing_window_days=7)).collect()}
    assert seven == {k: n for k, e in ends.items()
                     if (n := sum(any(e - dt.timedelta(7) < d <= e for d in x) for x in (
                         [D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5), end], [D(2024, 1, 3), D(2024, 1, 4), D(2024, 1, 5)])))}
    for seg in (None, "business_unit"):
        last = [r for r in activity.stickiness(t, CFG, seg).collect() if r.week_number == 3]
        assert [(r.weekly_active_users, r.monthly_active_users, r.stickiness_pct) for r in last] == [(1, 2, 50.0)]
    trend = {r.week_number: (r.activated_users, r.dormant_users) for r in retention.dormancy_trend(t, CFG).collect()}
    assert trend == {1: (2, 0), 2: (2, 0), 3: (2, 0)}


def test_d9_recommendation_excludes_null_flags(spark):
    users = [user("a")]
    fb = [("1", "a", T(2024, 1, 2), 5, None, None, True), ("2", "a", T(2024, 1, 2), 4, None, None, None),
          ("3", "a", T(2024, 1, 3), 2, None, None, False)]
    t = make(spark, users, [], fb)
    r = feedback.recommendation_rate(t).collect()[0]
    assert (r.feedback_submissions, r.recommend_count, r.recommendation_rate_pct) == (2, 1, 50.0)
    w = feedback.weekly_feedback(t).collect()[0]
    assert (w.feedback_submissions, w.recommendation_rate_pct, w.avg_rating) == (3, 33.3, 3.67)


def test_d10_d11_feature_adoption_eligible_only_and_full_catalog(spark):
    users = [user("a"), user("b", eligible=False)]
    evs = [ev("1", "a", T(2024, 1, 2), "feature_completed"), ev("2", "b", T(2024, 1, 2), "feature_completed", feat="Meeting Notes")]
    t = make(spark, users, evs)
    rows = {r.feature_name: r for r in features.feature_adoption(t, CFG).collect()}
    assert len(rows) == 8 and rows["Knowledge Search"].adopted_users == 1 and rows["Meeting Notes"].adopted_users == 0


def test_role_matrix_has_every_feature_of_the_catalog(spark):
    t = make(spark, [user("a"), user("b")], [ev("1", "a", T(2024, 1, 2), "feature_completed", feat="Ninth Feature")])
    ninth = t.features.limit(1).withColumn("feature_id", F.lit("F9")).withColumn("feature_name", F.lit("Ninth Feature"))
    m = features.role_feature_matrix(t.replace(features=t.features.unionByName(ninth)), CFG)
    assert m.columns == ["role", *CFG.feature_names, "Ninth Feature"]
    row = m.collect()[0]
    assert float(row["Ninth Feature"]) == 50.0 and all(float(row[f]) == 0.0 for f in CFG.feature_names)


def test_d12_completion_requires_assignment(spark):
    users = [user("a"), user("b", assigned=None), user("c", trained=False)]
    t = make(spark, users, [])
    r = training.training_completion(t).collect()[0]
    assert (r.users_assigned, r.users_completed, r.training_completion_rate_pct) == (2, 1, 50.0)


def test_d13_week_over_week_uses_calendar_weeks(spark):
    users = [user("a")]
    evs = [ev("1", "a", T(2024, 1, 2)), ev("2", "a", T(2024, 1, 16))]  # weeks 1 and 3, nothing in week 2
    t = make(spark, users, evs)
    rows = {r.week_number: r for r in activity.wau_week_over_week(t, CFG, "business_unit").collect()}
    assert rows[2].weekly_active_users == 0 and rows[3].prior_week_wau == 0 and rows[3].wau_change == 1


def test_d14_top_barrier_tie_break(spark):
    users = [user("a")]
    fb = [(str(i), "a", T(2024, 1, 2), 3, b, None, True)
          for i, b in enumerate(["Low output quality", "No time to learn", "No time to learn", "Low output quality",
                                 "No barrier reported", "No barrier reported", "No barrier reported"])]
    t = make(spark, users, [], fb)
    assert feedback.top_barrier(t, CFG).collect()[0].top_barrier == "Low output quality"
    ties = feedback.top_barriers_with_ties(t, CFG).collect()
    assert sorted(r.barrier_category for r in ties) == ["Low output quality", "No time to learn"]


def test_d15_d18_outside_calendar_and_null_segment_dropped(spark):
    users = [user("a"), user("b", bu=None)]
    evs = [ev("1", "a", T(2024, 1, 2)), ev("2", "a", T(2025, 1, 2)), ev("3", "b", T(2024, 1, 2))]
    t = make(spark, users, evs)
    rows = activity.weekly_active_users(t, CFG, "business_unit").collect()
    assert [(r.week_number, r.business_unit, r.weekly_active_users) for r in rows] == [(1, "Ops", 1)]
    assert activity.weekly_active_users(t, CFG).collect()[0].weekly_active_users == 2


def test_retention_week0_is_100(spark):
    users = [user("a"), user("b")]
    evs = [ev("1", "a", T(2024, 1, 2)), ev("2", "a", T(2024, 1, 9)), ev("3", "b", T(2024, 1, 9))]
    t = make(spark, users, evs)
    rows = {(r.cohort_week, r.weeks_since_activation): r for r in retention.retention_cohorts(t, CFG).collect()}
    assert rows[(1, 0)].retention_rate_pct == 100.0 and rows[(1, 1)].active_users == 1 and rows[(2, 0)].cohort_users == 1


def test_hot_user_does_not_change_results(spark):
    """One user owning most events: pre-aggregation keeps answers exact."""
    users = [user("hot"), user("x")]
    evs = [ev(f"h{i}", "hot", T(2024, 1, 2 + i % 20, i % 24)) for i in range(3000)] + [ev("x1", "x", T(2024, 1, 3))]
    t = make(spark, users, evs)
    assert population.activation_rate(t, CFG).collect()[0].activated_users == 1
    wau = {r.week_number: r.weekly_active_users for r in activity.weekly_active_users(t, CFG).collect()}
    assert wau[1] == 2 and wau[2] == 1
