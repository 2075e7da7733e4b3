"""Time-to-value and modelled time saved (M-21 ... M-23, M-32)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG, TIME_SAVED_DISCLAIMER
from uptake.functions import half_up_decimal, hours_between
from uptake.operators.common import Segment, bounded_broadcast, known_users, not_null, seg_list, user_summary
from uptake.operators.population import eligible_users
from uptake.operators.quantiles import exact_percentile
from uptake.tables import Tables


def time_to_value(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per user: hours from access date (midnight) to the first successful
    value event at or after it. Population: anyone with an access date, or
    eligible users only with ``cfg.ttv_eligible_only``."""
    pop = eligible_users(t) if cfg.ttv_eligible_only else t.users.where(F.col("assigned_access_date").isNotNull())
    access_ts = F.col("assigned_access_date").cast("timestamp_ntz")
    fv = user_summary(t, cfg).select("user_id", "first_value_ts")
    return (
        pop.join(fv, "user_id")
        .where(F.col("first_value_ts") >= access_ts)
        .withColumn("hours_to_value", hours_between("assigned_access_date", "first_value_ts"))
    )


def median_time_to_value(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None) -> DataFrame:
    """users_with_first_value and exact median hours (1 decimal) per segment.

    The median is exact but computed with bounded per-task state
    (:func:`uptake.operators.quantiles.exact_percentile`), so a segment that
    holds a third of all users is never gathered into one aggregation buffer.
    """
    cols = seg_list(segment)
    m = exact_percentile(time_to_value(t, cfg).where(not_null(cols)), "hours_to_value", cols, 0.5,
                         accuracy=50_000, alias="median")
    return m.select(*cols, F.col("n").alias("users_with_first_value"),
                    F.round("median", 1).alias("median_hours_to_value"))


def ttv_histogram(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Users per fixed-width bin of hours to value (bin start, inclusive)."""
    w = cfg.ttv_bin_hours
    b = (F.floor(F.col("hours_to_value") / w) * w).cast("long")
    return time_to_value(t, cfg).groupBy(b.alias("bin_start_hours")).agg(F.count(F.lit(1)).alias("users"))


def ttv_histogram_clipped(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, clip: float = 200.0, bins: int = 40) -> DataFrame:
    """Users per bin of hours to value, clipped at ``clip``: ``bins`` bins of equal width from the least to the greatest
    clipped value (of width 1 around it if there is but one), the last one closed; empty bins have 0 users."""
    x = time_to_value(t, cfg).select(F.least("hours_to_value", F.lit(float(clip))).alias("x"))
    span = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).where("lo IS NOT NULL").select(
        F.when(F.col("hi") > F.col("lo"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        (F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(1.0)) / bins).alias("width"))
    s = span.select(F.struct("lo", "width").alias("s")).scalar()
    placed = x.withColumn("s", s).select(
        F.least(F.floor((F.col("x") - F.col("s.lo")) / F.col("s.width")), F.lit(bins - 1)).cast("int").alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("users"))
    grid = span.select("lo", "width", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start_hours"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end_hours"), F.coalesce("users", F.lit(0)).cast("long").alias("users"))


def hours_of_tenths(minutes) -> Column:
    """Hours (one decimal) of minutes that were rounded to one decimal first."""
    tenths = F.call_function("div", F.col(minutes) * 20 + 1, F.lit(2))  # minutes x10, rounded half up
    return half_up_decimal(tenths, F.lit(600), 1)


def _per_known_user(events: DataFrame, t: Tables, cols: list[str]) -> DataFrame:
    """Estimates and their minutes per ``cols``, of known users (D19): summed per user first, so that the users table
    meets one row a user and group."""
    per_user = events.groupBy("user_id", *cols).agg(
        F.count("estimated_minutes_saved").alias("n"), F.sum("estimated_minutes_saved").alias("m"))
    return known_users(per_user, t).groupBy(*cols).agg(
        F.sum("n").alias("successful_actions_with_estimate"), F.sum("m").alias("minutes"))


def time_saved_by_feature(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """All events carrying an estimate, per catalog feature (unknown feature
    excluded; features with events but no estimate are listed with nulls)."""
    cat = bounded_broadcast(t.features.select("feature_name"), t.features)
    agg = _per_known_user(t.events.join(cat, "feature_name"), t, ["feature_name"])
    return agg.select(
        "feature_name", "successful_actions_with_estimate",
        half_up_decimal("minutes", F.lit(1), 0).alias("total_estimated_minutes_saved"),
        half_up_decimal("minutes", F.lit(60), 1).alias("total_estimated_hours_saved"),
        half_up_decimal("minutes", "successful_actions_with_estimate", 1)
        .alias("avg_estimated_minutes_saved_per_action"),
        F.lit(TIME_SAVED_DISCLAIMER).alias("disclaimer"),
    )


def time_saved_value_events(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = "feature_name") -> DataFrame:
    """Successful value events with an estimate, per segment (event column).

    Minutes are rounded to 1 decimal first and hours derived from the rounded
    minutes, as the per-feature summary table does.
    """
    cols = seg_list(segment)
    ev = t.events.where(
        F.col("event_type").isin(*cfg.value_event_types)
        & F.coalesce("successful_completion_flag", F.lit(False))
        & F.col("estimated_minutes_saved").isNotNull()
        & not_null(cols)
    )
    agg = _per_known_user(ev, t, cols)
    return agg.select(
        *cols, "successful_actions_with_estimate",
        half_up_decimal("minutes", F.lit(1), 1).alias("total_estimated_minutes_saved"),
        half_up_decimal("minutes", "successful_actions_with_estimate", 1)
        .alias("avg_estimated_minutes_saved_per_action"),
        hours_of_tenths("minutes").alias("total_estimated_hours_saved"),
        F.lit(TIME_SAVED_DISCLAIMER).alias("disclaimer"),
    )
