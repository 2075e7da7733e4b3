"""Eligible population and activation (M-01 ... M-07)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.functions import pct1
from uptake.operators.common import Segment, not_null, seg_list, user_day_activity, user_summary
from uptake.tables import Tables


def eligible_users(t: Tables) -> DataFrame:
    """Users flagged eligible (null counts as not) who have an access date."""
    return t.users.where(
        F.coalesce(F.col("eligible_for_access_flag"), F.lit(False)) & F.col("assigned_access_date").isNotNull()
    )


def actions_in_window(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Meaningful actions per eligible user from access date to access + N days
    (users with at least one such action). Boundary "date": the whole of day
    N counts; "instant": only its midnight."""
    el = eligible_users(t).select("user_id")
    return user_summary(t, cfg).join(el, "user_id").where(F.col("meaningful_action_count") > 0).select(
        "user_id", "meaningful_action_count")


def qualifying_feature_users(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Distinct users with any event on the qualifying feature (any event type)."""
    return user_day_activity(t, cfg).where(F.col("n_qualifying") > 0).select("user_id").distinct()


def activation_users(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per eligible user with the activation decision and its inputs.

    activated = (completed training OR used qualifying feature)
                AND meaningful actions in window >= min actions
    """
    el = eligible_users(t)
    out = (
        el.join(user_summary(t, cfg), "user_id", "left")
        .withColumn("meaningful_action_count", F.coalesce(F.col("meaningful_action_count"), F.lit(0)).cast("long"))
        .withColumn("used_qualifying_feature", F.coalesce(F.col("used_qualifying_feature"), F.lit(False)))
        .withColumn("completed_training", F.col("training_completed_date").isNotNull())
    )
    met = F.col("completed_training") | F.col("used_qualifying_feature")
    return out.withColumn("met_qualification_condition", met).withColumn(
        "activated", met & (F.col("meaningful_action_count") >= cfg.activation_min_actions)
    )


def activation_rate(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None,
                    activation: DataFrame | None = None) -> DataFrame:
    """eligible_users, activated_users, activation_rate_pct overall or per segment.

    Null segment values are dropped (they have no row in the segment
    dimension).
    """
    cols = seg_list(segment)
    act = activation if activation is not None else activation_users(t, cfg)
    return (
        act.where(not_null(cols))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("eligible_users"), F.count_if("activated").alias("activated_users"))
        .withColumn("activation_rate_pct", pct1("activated_users", "eligible_users"))
    )


def activation_rollup(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segments: tuple[str, ...] = ("business_unit", "rollout_wave")) -> DataFrame:
    """Activation of the company and of every value of several segments, from one expansion of the activation rows.

    Rows ``(level, value, eligible_users, activated_users, activation_rate_pct)``: level ``company`` with a null value,
    and one level for each segment column, without users whose value is null there.
    """
    act = activation_users(t, cfg).select(*segments, "activated")
    sets = [[], *[[F.col(c)] for c in segments]]
    rows = act.groupingSets(sets, *[F.col(c) for c in segments]).agg(
        F.count(F.lit(1)).alias("eligible_users"), F.count_if("activated").alias("activated_users"),
        *[F.grouping(c).alias(f"_out_{c}") for c in segments])
    level, value = F.lit("company"), F.lit(None).cast("string")
    for c in segments:
        level = F.when(F.col(f"_out_{c}") == 0, F.lit(c)).otherwise(level)
        value = F.when(F.col(f"_out_{c}") == 0, F.col(c).cast("string")).otherwise(value)
    return rows.select(
        level.alias("level"), value.alias("value"), "eligible_users", "activated_users",
        pct1("activated_users", "eligible_users").alias("activation_rate_pct")).where(
        (F.col("level") == "company") | F.col("value").isNotNull())
