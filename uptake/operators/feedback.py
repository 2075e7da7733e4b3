"""Feedback: recommendation, ratings, barriers (M-33 ... M-39)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.functions import half_up_ratio, pct1
from uptake.operators.common import Segment, day_weeks, not_null, seg_list, user_segment
from uptake.tables import Tables


def _with_segment(t: Tables, fb: DataFrame, cols: list[str], keys: list[str], aggs) -> DataFrame:
    """Aggregate feedback by segment; user-level segments are attached after a
    per-user pre-aggregation so the users join never sees a hot user's rows."""
    user_cols = [c for c in cols if c not in fb.columns]
    if not user_cols:
        return fb.where(not_null(cols)).groupBy(*cols, *keys).agg(*[a for a, _ in aggs])
    fb_cols = [c for c in cols if c in fb.columns]
    pre = fb.groupBy("user_id", *fb_cols, *keys).agg(*[a for a, _ in aggs])
    merged = pre.join(user_segment(t, user_cols), "user_id").where(not_null(cols))
    return merged.groupBy(*cols, *keys).agg(*[m for _, m in aggs])


def recommendation_rate(t: Tables, segment: Segment = None) -> DataFrame:
    """Recommended / feedback with a non-null flag."""
    cols = seg_list(segment)
    fb = t.feedback.where(F.col("would_recommend_flag").isNotNull())
    aggs = [
        (F.count(F.lit(1)).alias("feedback_submissions"), F.sum("feedback_submissions").alias("feedback_submissions")),
        (F.count_if("would_recommend_flag").alias("recommend_count"), F.sum("recommend_count").alias("recommend_count")),
    ]
    return _with_segment(t, fb, cols, [], aggs).withColumn(
        "recommendation_rate_pct", pct1("recommend_count", "feedback_submissions")
    )


def avg_rating(t: Tables, segment: Segment = "feature_name") -> DataFrame:
    """Average rating (2 decimals) per segment; unrated rows do not count."""
    cols = seg_list(segment)
    aggs = [
        (F.count(F.lit(1)).alias("feedback_submissions"), F.sum("feedback_submissions").alias("feedback_submissions")),
        (F.count("rating_1_to_5").alias("rated_submissions"), F.sum("rated_submissions").alias("rated_submissions")),
        (F.sum("rating_1_to_5").cast("long").alias("rating_sum"), F.sum("rating_sum").alias("rating_sum")),
    ]
    return _with_segment(t, t.feedback, cols, [], aggs).select(
        *cols, "feedback_submissions", "rated_submissions",
        half_up_ratio("rating_sum", "rated_submissions", 2).alias("avg_rating"),
    )


def barrier_counts(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = "business_unit") -> DataFrame:
    """Mentions per (segment, barrier), 'no barrier' and null excluded."""
    cols = seg_list(segment)
    fb = t.feedback.where(F.col("barrier_category").isNotNull() & (F.col("barrier_category") != cfg.no_barrier_label))
    aggs = [(F.count(F.lit(1)).alias("mentions"), F.sum("mentions").alias("mentions"))]
    return _with_segment(t, fb, cols, ["barrier_category"], aggs)


def barrier_ranking(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = "business_unit") -> DataFrame:
    """Barriers ranked per segment (ties share a rank), with share of mentions."""
    cols = seg_list(segment)
    c = barrier_counts(t, cfg, cols)
    part = Window.partitionBy(*cols) if cols else Window.partitionBy()
    return c.select(
        *cols, "barrier_category", "mentions",
        pct1("mentions", F.sum("mentions").over(part)).alias("pct_of_barrier_mentions"),
        F.rank().over(part.orderBy(F.desc("mentions"))).cast("long").alias("barrier_rank"),
    )


def top_barriers_with_ties(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = "business_unit") -> DataFrame:
    return barrier_ranking(t, cfg, segment).where(F.col("barrier_rank") == 1)


def top_barrier(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: Segment = None,
                counts: DataFrame | None = None) -> DataFrame:
    """Exactly one barrier per segment: most mentions, then name ascending."""
    cols = seg_list(segment)
    c = counts if counts is not None else barrier_counts(t, cfg, cols)
    w = (Window.partitionBy(*cols) if cols else Window.partitionBy()).orderBy(F.desc("mentions"), "barrier_category")
    return c.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(
        *cols, F.col("barrier_category").alias("top_barrier"), "mentions"
    )


def weekly_feedback(t: Tables, segment: Segment = "business_unit") -> DataFrame:
    """Per week x segment: submissions, average rating, recommendation %
    (here every submission is in the denominator, as in the weekly table)."""
    cols = seg_list(segment)
    fb = t.feedback.withColumn("date", F.to_date("feedback_timestamp")).join(day_weeks(t), "date")
    aggs = [
        (F.count(F.lit(1)).alias("feedback_submissions"), F.sum("feedback_submissions").alias("feedback_submissions")),
        (F.count("rating_1_to_5").alias("rated"), F.sum("rated").alias("rated")),
        (F.sum("rating_1_to_5").cast("long").alias("rating_sum"), F.sum("rating_sum").alias("rating_sum")),
        (F.count_if(F.coalesce("would_recommend_flag", F.lit(False))).alias("recommended"),
         F.sum("recommended").alias("recommended")),
    ]
    g = _with_segment(t, fb, cols, ["week_number"], aggs)
    return g.select(
        "week_number", *cols, "feedback_submissions",
        half_up_ratio("rating_sum", "rated", 2).alias("avg_rating"),
        pct1("recommended", "feedback_submissions").alias("recommendation_rate_pct"),
    )


def feedback_anonymised(t: Tables, segment: Segment = "business_unit") -> DataFrame:
    """Feedback rows without the user id (segment attached for slicing)."""
    cols = seg_list(segment)
    return t.feedback.join(user_segment(t, cols), "user_id", "left").select(
        "feedback_id", "feedback_timestamp", *cols, "feature_name", "rating_1_to_5", "sentiment_label",
        "barrier_category", "free_text_feedback", "would_recommend_flag",
    )
