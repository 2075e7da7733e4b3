"""Report tables (R-01 ... R-19): compositions of the metric operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG, WEEKLY_DISCLAIMER
from uptake.functions import half_up_decimal, half_up_ratio, idiv, pct1
from uptake.operators import activity, features, feedback, population, retention, training, value
from uptake.operators.common import (
    Segment, active_days, day_weeks, last_event_date, not_null, pivot_values, precompute, seg_list, user_feature_activity,
    user_segment, with_scalars,
)
from uptake.tables import Tables


def weekly_insights(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    """One row per (week, segment) with activity, value and feedback blocks.

    All event blocks come from ONE user x week rollup of the user-day summary
    (WAU, minutes saved, qualifying-feature use), joined to
    the users table at user x week grain; feedback is pre-aggregated once per
    user x week x reported barrier and feeds both the feedback block and the
    top barrier. Prior-week values come from LAG over the segment's weekly rows.
    """
    uw = activity.user_weeks(t, cfg).withColumn("pl", (F.col("n_qualifying") > 0).cast("int"))
    users = t.users.select("user_id", segment)
    # one aggregation per (week, segment) INCLUDING the null segment: a user
    # has one segment value, so the company WAU of a week is the sum of its
    # segment rows (a window over weeks x segments, bounded) -- no second
    # branch over the user-week rows
    seg = (
        uw.join(users, "user_id")
        .groupBy("week_number", "week_start_date", segment).agg(
            F.count(F.lit(1)).alias("weekly_active_users"),
            F.coalesce(F.sum("minutes"), F.lit(0)).alias("minutes"),
            F.coalesce(F.sum("pl"), F.lit(0)).cast("long").alias("prompt_library_users"),
        )
        .withColumn("company_wau", F.sum("weekly_active_users").over(Window.partitionBy("week_number")))
        .where(F.col(segment).isNotNull())
    )
    # feedback: ONE pre-aggregation per (user, week, reported barrier) and one
    # users join feed both the weekly block and the barrier counts
    fbw = t.feedback.withColumn("date", F.to_date("feedback_timestamp")).join(day_weeks(t), "date")
    b = F.col("barrier_category")
    fj = (
        fbw.groupBy("user_id", "week_number", F.when(b.isNotNull() & (b != cfg.no_barrier_label), b).alias("barrier"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count("rating_1_to_5").alias("rated"),
            F.sum("rating_1_to_5").cast("long").alias("rating_sum"),
            F.count_if(F.coalesce("would_recommend_flag", F.lit(False))).alias("recommended"),
        )
        .join(user_segment(t, segment), "user_id")
    )
    fb = fj.groupBy("week_number", segment).agg(
        F.sum("n").alias("n"), F.sum("rated").alias("rated"), F.sum("rating_sum").alias("rating_sum"),
        F.sum("recommended").alias("recommended"),
    ).select(
        "week_number", segment, F.col("n").alias("feedback_submissions"),
        half_up_ratio("rating_sum", "rated", 2).alias("avg_rating"),
        pct1("recommended", "n").alias("recommendation_rate_pct"),
    )
    bar = fj.where(F.col("barrier").isNotNull()).groupBy(
        "week_number", segment, F.col("barrier").alias("barrier_category")).agg(F.sum("n").alias("mentions"))
    top = feedback.top_barrier(t, cfg, ["week_number", segment], counts=bar)
    w = Window.partitionBy(segment).orderBy("week_number")
    prior = F.lag("weekly_active_users").over(w)
    return (
        seg.join(fb, ["week_number", segment], "left")
        .join(top, ["week_number", segment], "left")
        .select(
            "week_number", "week_start_date", segment, "weekly_active_users",
            prior.alias("prior_week_wau"),
            (F.col("weekly_active_users") - prior).alias("wau_change_vs_prior_week"),
            pct1("weekly_active_users", "company_wau").alias("pct_of_company_wau_this_week"),
            "prompt_library_users",
            half_up_decimal("minutes", F.lit(60), 1).alias("estimated_hours_saved_modeled"),
            F.coalesce("feedback_submissions", F.lit(0)).cast("long").alias("feedback_submissions"),
            "avg_rating", "recommendation_rate_pct",
            F.col("top_barrier").alias("top_reported_barrier"),
            F.lit(WEEKLY_DISCLAIMER).alias("disclaimer"),
        )
    )


def _frac(pct_col: str) -> Column:
    return F.col(pct_col) / F.lit(100.0)


def segment_scorecard(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    """Activation, median time-to-value, training completion and dormancy per segment.

    Eligible / activated / dormant counts come from ONE aggregation over the
    activation frame (which carries each user's last active date), so
    activation and dormancy share a single pass; the median and the training
    block are the other two branches. The user-day summary that all of them
    need is written once, so the events are read once.
    """
    t = precompute(t, cfg)
    act = population.activation_users(t, cfg).where(F.col(segment).isNotNull())
    as_of = last_event_date(t, cfg)
    recent = F.coalesce(F.col("last_active_date") > F.date_sub(as_of, cfg.trailing_window_days), F.lit(False))
    counts = act.groupBy(segment).agg(
        F.count(F.lit(1)).alias("eligible_users"),
        F.count_if("activated").alias("activated_users"),
        F.count_if(F.col("activated") & ~recent).alias("dormant_users"),
    )
    ttv = value.median_time_to_value(t, cfg, segment)
    tr = training.training_completion(t, segment)
    return (
        counts.join(ttv, segment, "left").join(tr, segment, "left")
        .select(
            segment, "eligible_users", "activated_users",
            (pct1("activated_users", "eligible_users") / F.lit(100.0)).alias("activation_rate"),
            "median_hours_to_value",
            _frac("training_completion_rate_pct").alias("training_completion_rate"),
            (pct1("dormant_users", "activated_users") / F.lit(100.0)).alias("dormancy_rate"),
        )
    )


def feature_scorecard(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """Adoption and time saved per catalog feature, from one pass over the events: users x features are joined once to
    the eligible users, then adopters are counted and minutes summed by the same aggregation."""
    el = population.eligible_users(t).select("user_id")
    per_user = user_feature_activity(t, cfg).groupBy("user_id", "feature_name").agg(
        F.sum("n_adoptions").alias("n"), F.sum("n_estimates").alias("estimates"), F.sum("minutes").alias("minutes"))
    facts = per_user.join(el.withColumn("eligible", F.lit(True)), "user_id", "left").groupBy("feature_name").agg(
        F.count_if(F.col("eligible") & (F.col("n") > 0)).alias("adopted_users"),
        F.sum("estimates").alias("estimates"), F.sum("minutes").alias("minutes"))
    grid = el.agg(F.count(F.lit(1)).alias("eligible_users")).select(
        "eligible_users", F.explode(features.feature_list(t)).alias("feature_name"))
    return grid.join(facts, "feature_name", "left").select(
        "feature_name", "eligible_users", F.coalesce("adopted_users", F.lit(0)).cast("long").alias("adopted_users"),
        (pct1(F.coalesce("adopted_users", F.lit(0)), "eligible_users") / F.lit(100.0)).alias("feature_adoption_rate"),
        F.when(F.col("estimates") > 0, value.hours_of_tenths("minutes")).alias("total_estimated_hours_saved"),
    )


def _segment_values(t: Tables, cfg: AdoptionConfig, segment: str) -> list[str]:
    listed = list(cfg.canonical_business_units) if segment == "business_unit" else []
    return pivot_values(user_segment(t, segment), segment, listed)


def barrier_matrix(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    """Segment x barrier mention counts, one column per barrier, 0-filled."""
    values = [b for b in cfg.barrier_categories if b != cfg.no_barrier_label]
    c = feedback.barrier_counts(t, cfg, [segment])
    values = pivot_values(c, "barrier_category", values)
    return c.groupBy(segment).pivot("barrier_category", values).agg(F.sum("mentions")).fillna(0, subset=values)


def feature_usage_matrix(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    """Feature x segment count of adoption events, 0-filled."""
    values = _segment_values(t, cfg, segment)
    pre = user_feature_activity(t, cfg).where("n_adoptions > 0").groupBy("user_id", "feature_name").agg(F.sum("n_adoptions").alias("n"))
    j = pre.join(user_segment(t, segment), "user_id")
    return j.groupBy("feature_name").pivot(segment, values).agg(F.sum("n")).fillna(0, subset=values)


def wau_matrix(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    """Week x segment WAU, 0-filled."""
    values = _segment_values(t, cfg, segment)
    w = activity.weekly_active_users(t, cfg, segment)
    return w.groupBy("week_number").pivot(segment, values).agg(F.sum("weekly_active_users")).fillna(0, subset=values)


def headline_kpis(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit",
                  below: float = 0.75, wau_from_week: int = 12, feature_above: float = 0.5) -> DataFrame:
    """One row of workbook KPIs. The average completion rate is the
    unweighted mean of segment rates; sums of rounded values are done on
    integer tenths so they are exact.

    Only the scorecard's activation counts are needed, so they are computed
    directly (no median / dormancy branches)."""
    t = precompute(t, cfg)  # activation and weekly counts read one written summary
    act = population.activation_users(t, cfg).where(F.col(segment).isNotNull()).groupBy(segment).agg(
        F.count(F.lit(1)).alias("eligible_users"), F.count_if("activated").alias("activated_users"))
    tr = training.training_completion(t, segment)
    a = act.join(tr.select(segment, "training_completion_rate_pct"), segment, "left").agg(
        F.sum("eligible_users").cast("long").alias("total_eligible_users"),
        F.sum("activated_users").cast("long").alias("total_activated_users"),
        F.sum((F.col("training_completion_rate_pct") * 10).cast("long")).alias("tr_tenths"),
        F.count("training_completion_rate_pct").alias("tr_n"),
        F.count_if(pct1("activated_users", "eligible_users") / F.lit(100.0) < below).alias("segments_below_threshold"),
    )
    wau = activity.weekly_active_users(t, cfg).where(F.col("week_number") >= wau_from_week).agg(
        F.sum("weekly_active_users").cast("long").alias("total_wau_from_week")
    )
    fs = feature_scorecard(t, cfg).agg(
        F.count_if(F.col("feature_adoption_rate") > feature_above).alias("features_above_threshold"),
        F.sum((F.col("total_estimated_hours_saved") * 10).cast("long")).alias("hours_tenths"),
    )
    return with_scalars(with_scalars(a, wau), fs).select(  # three one-row aggregates
        "total_eligible_users", "total_activated_users",
        F.try_divide(F.col("total_activated_users").cast("double"), F.col("total_eligible_users").cast("double"))
        .alias("company_activation_rate"),
        (F.col("tr_tenths").cast("double") / (F.col("tr_n") * 1000).cast("double")).alias("avg_training_completion_rate"),
        "segments_below_threshold", "total_wau_from_week", "features_above_threshold",
        (F.col("hours_tenths").cast("double") / F.lit(10.0)).alias("total_estimated_hours_saved"),
    )


def segment_lookup(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, value_: str = "", segment: str = "business_unit") -> DataFrame:
    """KPIs of one named segment, or a 'Not found' row when it does not exist."""
    sc = segment_scorecard(t, cfg, segment)
    hit = sc.where(F.col(segment) == value_)
    agg = hit.agg(
        F.count(F.lit(1)).alias("n"),
        F.max("activation_rate").alias("activation_rate"),
        F.max("median_hours_to_value").alias("median_hours_to_value"),
        F.max("dormancy_rate").alias("dormancy_rate"),
    )
    return agg.select(
        F.lit(value_).alias(segment),
        F.when(F.col("n") > 0, F.lit("Found")).otherwise(F.lit("Not found")).alias("lookup_status"),
        "activation_rate", "median_hours_to_value", "dormancy_rate",
    )


def low_adoption_segments(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    act = population.activation_rate(t, cfg, segment)
    return act.agg(
        F.count_if(F.try_divide(F.col("activated_users").cast("double"), F.col("eligible_users").cast("double"))
                   < F.lit(cfg.low_adoption_threshold)).alias("low_adoption_segments"),
        F.count(F.lit(1)).alias("segments"),
    ).select(F.lit(cfg.low_adoption_threshold).alias("threshold"), "low_adoption_segments", "segments")


def adoption_funnel(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """eligible -> completed training -> >= 1 meaningful action -> activated."""
    act = population.activation_users(t, cfg)
    ever = active_days(t, cfg).select("user_id").distinct().withColumn("ever_active", F.lit(True))
    one = act.join(ever, "user_id", "left").agg(
        F.count(F.lit(1)).alias("s1"),
        F.count_if("completed_training").alias("s2"),
        F.count_if(F.col("ever_active").isNotNull()).alias("s3"),
        F.count_if("activated").alias("s4"),
    )
    st = one.select(F.expr(
        "stack(4, 1, 'Eligible users', s1, 2, 'Completed training', s2, "
        "3, 'At least one meaningful action', s3, 4, 'Activated users', s4) AS (stage_order, stage, users)"
    ))
    w = Window.orderBy("stage_order")
    first = F.first("users").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    prev = F.lag("users").over(w)
    return st.select(
        "stage_order", "stage", "users",
        pct1("users", first).alias("pct_of_eligible"),
        (prev - F.col("users")).alias("drop_off_from_previous"),
    )


def training_activation_points(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    act = population.activation_rate(t, cfg, segment)
    tr = training.training_completion(t, segment)
    return act.join(tr, segment, "left").select(
        segment, "eligible_users", "activation_rate_pct", "training_completion_rate_pct"
    )


def priority_quadrant(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    """Place each segment against the medians of eligible users and activation:
    low activation & training below median -> training gap; low activation &
    many eligible -> biggest-impact fix; high activation split by rating."""
    pts = training_activation_points(t, cfg, segment).join(
        feedback.avg_rating(t, segment).select(segment, "avg_rating"), segment, "left"
    )
    med = pts.agg(
        F.median("eligible_users").alias("m_elig"), F.median("activation_rate_pct").alias("m_act"),
        F.median("training_completion_rate_pct").alias("m_tr"), F.median("avg_rating").alias("m_rat"),
    )
    j = with_scalars(pts, med)  # medians across a handful of segment rows
    low_act = F.col("activation_rate_pct") < F.col("m_act")
    label = (
        F.when(low_act & (F.col("training_completion_rate_pct") < F.col("m_tr")), F.lit("Training gap"))
        .when(low_act & (F.col("eligible_users") >= F.col("m_elig")), F.lit("Biggest-impact fix"))
        .when(low_act, F.lit("Monitor"))
        .when(F.col("avg_rating") < F.col("m_rat"), F.lit("High activity, low satisfaction"))
        .otherwise(F.lit("High activity, high satisfaction"))
    )
    return j.select(segment, "eligible_users", "activation_rate_pct", "training_completion_rate_pct", "avg_rating",
                    label.alias("quadrant"))


def segment_actions(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segment: str = "business_unit") -> DataFrame:
    pts = training_activation_points(t, cfg, segment)
    top = feedback.top_barrier(t, cfg, segment).select(segment, "top_barrier")
    return pts.join(top, segment, "left").select(
        segment, "activation_rate_pct", "training_completion_rate_pct", "top_barrier"
    )


def executive_narrative(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """The one-sentence takeaway for the (filtered) tables."""
    act = population.activation_rate(t, cfg)
    wow = activity.wau_week_over_week(t, cfg)
    last = wow.agg(F.max_by(F.struct("wau_change"), "week_number").alias("s")).select(
        F.coalesce(F.col("s.wau_change"), F.lit(0)).alias("wau_change")
    )
    top = feedback.top_barrier(t, cfg).select("top_barrier")
    j = with_scalars(with_scalars(act, last), top)  # one-row inputs
    sentence = F.concat(
        F.lit("This period, activation rate is "), F.format_string("%.1f%%", "activation_rate_pct"),
        F.lit(", weekly active users are "),
        F.when(F.col("wau_change") >= 0, F.lit("up")).otherwise(F.lit("down")), F.lit(" "),
        F.format_number(F.abs("wau_change"), 0),
        F.lit(' vs. last week, and the most commonly reported barrier is "'), F.coalesce("top_barrier", F.lit("none")),
        F.lit('". (Synthetic data — association only, not a causal claim.)'),
    )
    return j.select("activation_rate_pct", "wau_change", "top_barrier", sentence.alias("narrative"))


def activation_by_access_week(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    act = population.activation_users(t, cfg).withColumnRenamed("assigned_access_date", "date")
    return population.activation_rate(t, cfg, "week_number", activation=act.join(day_weeks(t), "date"))


def profile_counts(t: Tables) -> DataFrame:
    """Long-form value counts of the main categorical columns."""
    specs = [
        ("users", "business_unit", t.users), ("users", "role", t.users),
        ("events", "event_type", t.events), ("events", "feature_name", t.events),
        ("feedback", "rating_1_to_5", t.feedback), ("feedback", "barrier_category", t.feedback),
    ]
    parts = [
        df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n")).select(F.lit(tbl).alias("table_name"), F.lit(c).alias("column_name"), "value", "n")
        for tbl, c, df in specs
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def target_segments(t: Tables, cfg: AdoptionConfig = DEFAULT_CONFIG, segments: Sequence[str] = (),
                    barriers: Sequence[str] = (), heavy_min_events: int = 5) -> DataFrame:
    """Recruiting lists: eligible-not-activated users in given segments; users
    reporting given barriers; heavy users of the qualifying feature."""
    act = population.activation_users(t, cfg)
    a = act.where(~F.col("activated") & F.col("business_unit").isin(*segments)).select(
        F.lit("eligible_not_activated").alias("reason"), "user_id")
    b = t.feedback.where(F.col("barrier_category").isin(*barriers)).select("user_id").distinct().select(
        F.lit("reported_barrier").alias("reason"), "user_id")
    c = (
        t.events.where(F.col("feature_name") == cfg.qualifying_feature).groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= heavy_min_events)
        .select(F.lit("heavy_qualifying_feature_user").alias("reason"), "user_id")
    )
    return a.unionByName(b).unionByName(c).join(t.users.select("user_id", "business_unit"), "user_id", "left")


def table_profile(t: Tables) -> DataFrame:
    """R-17: rows and columns per table (column counts come from the schema)."""
    named = [("users", t.users), ("usage_events", t.events), ("feedback", t.feedback), ("calendar", t.calendar),
             ("feature_catalog", t.features), ("training_sessions", t.training)]
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")) for n, df in named]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
