"""Integrity checks find violations when they exist (not only zeros)."""

import datetime as dt

from pyspark.sql import functions as F

from uptake.operators import star
from uptake.tables import Tables
from tests.test_truth_cases import ev, make, user

T = dt.datetime


def test_checks_detect_violations(spark):
    users = [user("a"), user("a", bu="Tech"), user("b")]          # duplicate user id
    evs = [ev("1", "a", T(2024, 1, 2)), ev("2", "zz", T(2024, 1, 3)),  # orphan user (dropped from the fact)
           ev("3", "b", T(2025, 6, 1))]                            # date outside the calendar
    t = make(spark, users, evs)
    lit = F.lit
    t = t.replace(
        users=t.users.withColumns({"region": lit("EU"), "manager_level": lit("IC"), "hire_date": lit(None).cast("date"),
                                   "training_format": lit("Live"), "manager_champion_flag": lit(None).cast("boolean")}),
        events=t.events.withColumns({"output_exported_flag": lit(False), "prompt_category": lit("Drafting"), "source_system": lit("web_app"), "session_duration_seconds": lit(1),
                                     "error_flag": lit(False), "platform": lit("Web"), "session_id": lit("s")}),
        feedback=t.feedback.withColumns({"sentiment_label": lit("Neutral"), "free_text_feedback": lit(None).cast("string")}),
        training=t.training.withColumns({"training_session_id": lit("x"), "session_date": lit(None).cast("date"),
                                         "training_format": lit("Live"), "facilitator": lit("f"), "session_topic": lit("t")}),
    )
    tabs = star.star(t)
    pk = {(r.table_name, r.key_column): r.duplicate_rows for r in star.pk_violations(tabs).collect()}
    assert pk[("dim_user", "user_key")] == 2
    fk = {(r.table_name, r.column_name): r.violations for r in star.fk_violations(tabs).collect()}
    assert fk[("fact_usage_events", "date_key")] == 1
    assert fk[("fact_usage_events", "user_key")] == 0
    assert tabs["fact_usage_events"].where(F.col("event_id") == "2").count() == 0
    counts = {r.table_name: r.row_count for r in star.table_row_counts(tabs).collect()}
    assert counts["dim_feature"] == 9 and counts["fact_usage_events"] == 2  # orphan event dropped
