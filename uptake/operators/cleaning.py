"""Cleaning with a counted data-quality log (CL-01 ... CL-28).

Each ``clean_*`` function turns an all-string raw table into a typed clean
table plus an issue log. Steps are row-local column expressions except the
key dedup (one aggregation) and the access-date rule (one join), so the whole
pipeline is a single Spark plan per table. Counts are taken in ONE aggregate
pass over flag columns computed along the way; each flag is defined on the
rows that survived the earlier steps, which is what makes the counts depend
on step order exactly as the sequential definition does.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, CANONICAL_FEATURES, DEFAULT_CONFIG
from uptake.functions import (
    blank_to_null, is_blank, normalize_label, safe_date, safe_decimal, safe_double, safe_int, safe_timestamp, strip, to_bool,
)
from uptake.session import materialize


Cut = Callable[[DataFrame], DataFrame]


def _lazy(df: DataFrame) -> DataFrame:
    return df


@dataclass
class CleanResult:
    """A cleaning plan.

    ``flagged`` holds every deduplicated row with its parsed values and flags, ``metrics`` the aggregates over it that
    the issue log needs (name -> column), and ``finish`` splits a flagged frame into the clean and the quarantined rows.
    ``issues`` counts lazily, in a pass of its own; ``written`` writes the flagged rows once and observes the counts in
    that same pass.
    """

    flagged: DataFrame
    metrics: dict[str, Column]
    finish: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]]
    log: tuple[list[Issue], str, int]
    stages: dict = field(default_factory=dict)

    @property
    def clean(self) -> DataFrame:
        return self.finish(self.flagged)[0]

    @property
    def quarantine(self) -> DataFrame | None:
        return self.finish(self.flagged)[1]

    @property
    def counts(self) -> DataFrame:
        return self.flagged.agg(*[c.alias(n) for n, c in self.metrics.items()])

    @property
    def issues(self) -> DataFrame:
        return issue_log(self.counts, *self.log)

    def written(self, name: str) -> tuple[DataFrame, DataFrame | None, DataFrame]:
        """Clean rows, quarantined rows and issue log from one pass over the input.

        The flagged rows are written to the shared folder and the log's counts are observed on them as they are written.
        Nothing is shuffled between the observation and the write, so the counts come from the tasks whose output was
        committed, once each, whatever stages had to run again.
        """
        seen = Observation(name)
        flagged = materialize(self.flagged.observe(seen, *[c.alias(n) for n, c in self.metrics.items()]), name)
        counts = flagged.sparkSession.createDataFrame(
            [tuple(int(seen.get[n] or 0) for n in self.metrics)], ", ".join(f"{n} long" for n in self.metrics))
        return *self.finish(flagged), issue_log(counts, *self.log)


@dataclass(frozen=True)
class Issue:
    """One possible finding: logged when its count is > 0, or always when a
    'validated' text is given (count 0 then means the rule was checked)."""
    issue_type: str
    count_col: str
    resolution: str
    status: str
    validated: str | None = None


def standardize_columns(df: DataFrame) -> DataFrame:
    """CL-01: header names trimmed, lower-cased, spaces to underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def dedup_keep_first(df: DataFrame, key: str, order: str = "ingest_seq", copies_col: str | None = None,
                     cut: Cut = _lazy) -> DataFrame:
    """CL-02: one row per key, the first in ingest order.

    ``order`` is a number that no two rows of a key share, such as the ingest position of ``sources.csv``. The least
    position of each key is a hash aggregation, merged map-side, of two narrow columns. Only keys with several rows go
    on: they are joined back by key, one row a key, and of their rows those at another position are dropped. Where few
    keys repeat the join is a broadcast, so the other rows are neither sorted nor moved. ``cut`` may write the repeated
    keys, so that the plan of the join knows their size. ``copies_col`` adds each key's number of raw rows.
    """
    repeated = cut(df.groupBy(F.col(key).alias("_key")).agg(
        F.min(order).alias("_first"), F.count(F.lit(1)).alias("_rows")).where("_rows > 1"))
    first = F.coalesce(df[order] == repeated["_first"], df[order].isNotNull())  # keys that do not repeat have no _first
    copies = [F.coalesce(repeated["_rows"], F.lit(1)).cast("long").alias(copies_col)] if copies_col else []
    return df.join(repeated, df[key].eqNullSafe(repeated["_key"]), "left").where(first).select(*[df[c] for c in df.columns], *copies)


def issue_log(counts: DataFrame, issues: list[Issue], table: str, table_order: int) -> DataFrame:
    """Turn a one-row frame of counts into log rows (CL-19)."""
    rows = []
    for i, s in enumerate(issues):
        n = F.coalesce(F.col(s.count_col), F.lit(0)).cast("long")
        found = n > 0
        rows.append(F.struct(
            F.lit(table_order).alias("table_order"), F.lit(i + 1).alias("issue_order"), F.lit(table).alias("table_name"),
            F.lit(s.issue_type).alias("issue_type"), n.alias("affected_record_count"),
            (F.when(found, F.lit(s.resolution)).otherwise(F.lit(s.validated))).alias("resolution"),
            (F.when(found, F.lit(s.status)).otherwise(F.lit("Validated (no issue found)"))).alias("status"),
            (found | F.lit(s.validated is not None)).alias("_keep"),
        ))
    return counts.select(F.inline(F.array(*rows))).where("_keep").drop("_keep")


def _duplicates(key: str) -> Column:
    """Raw rows less distinct non-null keys, over the deduplicated rows."""
    return F.coalesce(F.sum("_copies"), F.lit(0)) - F.count(key)


def _not_in(c: Column, values) -> Column:
    """pandas ~isin: null is 'not in'."""
    return ~F.coalesce(c.isin(*values), F.lit(False))


# --------------------------------------------------------------------------- users

USER_ISSUES = [
    Issue("Duplicate user_id rows in users", "n_dupe", "Kept the first row of each user_id in ingest order.", "Resolved"),
    Issue("business_unit label variants in users", "n_bu_variants", "Mapped case/space/abbreviation variants to canonical units.", "Resolved"),
    Issue("business_unit values outside the canonical list after normalisation", "n_bu_unmapped", "Kept as-is for review.", "Accepted"),
    Issue("Unparseable hire_date in users", "n_bad_hire", "Set to null.", "Resolved"),
    Issue("Unparseable assigned_access_date in users", "n_bad_access", "Set to null.", "Resolved"),
    Issue("Unparseable training_assigned_date in users", "n_bad_tr_assigned", "Set to null.", "Resolved"),
    Issue("Unparseable training_completed_date in users", "n_bad_tr_completed", "Set to null.", "Resolved"),
    Issue("Missing assigned_access_date in users", "n_missing_access", "Kept null; such users are outside usage metrics.", "Accepted"),
    Issue("Missing manager_champion_flag in users", "n_missing_champion", "Kept null (unknown), not assumed false.", "Accepted"),
    Issue("training_completed_date before training_assigned_date in users", "n_bad_order",
          "Completion date set to null; assignment kept.", "Resolved", "Rule checked; no violations."),
]


def _bad_parse(raw: Column, parsed: Column) -> Column:
    return ~is_blank(raw) & parsed.isNull()


def clean_users(raw: DataFrame, cfg: AdoptionConfig = DEFAULT_CONFIG, cut: Cut = _lazy) -> CleanResult:
    d = dedup_keep_first(standardize_columns(raw), "user_id", copies_col="_copies", cut=cut)
    bu = normalize_label(F.col("business_unit"), cfg.canonical_business_units, cfg.business_unit_label_map)
    dates = ["hire_date", "assigned_access_date", "training_assigned_date", "training_completed_date"]
    p = d.select(
        "user_id",
        F.col("business_unit").alias("_bu_raw"), bu.alias("business_unit"),
        *[strip(c).alias(c) for c in ("role", "region", "manager_level")],
        *[F.col(c).alias(f"_{c}_raw") for c in dates],
        *[safe_date(c).alias(c) for c in dates],
        safe_int("rollout_wave").alias("rollout_wave"),
        strip("training_format").alias("training_format"),
        to_bool("manager_champion_flag").alias("manager_champion_flag"),
        to_bool("eligible_for_access_flag").alias("eligible_for_access_flag"), "_copies",
    )
    bad_order = F.coalesce(F.col("training_completed_date") < F.col("training_assigned_date"), F.lit(False))
    p = p.withColumn("_bad_order", bad_order).withColumn(
        "training_completed_date", F.when(~F.col("_bad_order"), F.col("training_completed_date"))
    )
    metrics = {
        "n_dupe": _duplicates("user_id"),
        "n_bu_variants": F.count_if(_not_in(F.col("_bu_raw"), cfg.canonical_business_units)),
        "n_bu_unmapped": F.count_if(_not_in(F.col("business_unit"), cfg.canonical_business_units)),
        "n_bad_hire": F.count_if(_bad_parse(F.col("_hire_date_raw"), F.col("hire_date"))),
        "n_bad_access": F.count_if(_bad_parse(F.col("_assigned_access_date_raw"), F.col("assigned_access_date"))),
        "n_bad_tr_assigned": F.count_if(_bad_parse(F.col("_training_assigned_date_raw"), F.col("training_assigned_date"))),
        "n_bad_tr_completed": F.count_if(_bad_parse(F.col("_training_completed_date_raw"), F.col("training_completed_date"))
                                         & ~F.col("_bad_order")),
        "n_missing_access": F.count_if(F.col("assigned_access_date").isNull()),
        "n_missing_champion": F.count_if(F.col("manager_champion_flag").isNull()),
        "n_bad_order": F.count_if("_bad_order"),
    }

    def finish(flagged: DataFrame) -> tuple[DataFrame, None]:
        return flagged.select(
            "user_id", "business_unit", "role", "region", "manager_level", "hire_date", "assigned_access_date",
            "rollout_wave", "training_assigned_date", "training_completed_date", "training_format",
            "manager_champion_flag", "eligible_for_access_flag",
        ), None

    return CleanResult(p, metrics, finish, (USER_ISSUES, "users", 1), stages={"dedup": d, "parsed": p})


# --------------------------------------------------------------------------- events

EVENT_ISSUES = [
    Issue("Duplicate event_id rows in usage_events", "n_dupe", "Kept the first row of each event_id in ingest order.", "Resolved"),
    Issue("Unparseable event_timestamp in usage_events", "n_bad_ts", "Quarantined: a week cannot be assigned.", "Resolved"),
    Issue("feature_name label variants in usage_events", "n_feature_variants", "Mapped to canonical feature names.", "Resolved"),
    Issue("Missing feature_name in usage_events", "n_missing_feature", "Kept null; excluded from feature-level metrics.", "Accepted"),
    Issue("Negative session_duration_seconds in usage_events", "n_neg_duration", "Value set to null; event kept.", "Resolved"),
    Issue("Negative estimated_minutes_saved in usage_events", "n_neg_minutes", "Value set to null; event kept.", "Resolved"),
    Issue("usage_events before the user's assigned_access_date", "n_pre_access", "Removed.", "Resolved"),
    Issue("usage_events of users with no assigned_access_date on file", "n_no_access", "Kept and flagged.", "Accepted"),
    Issue("usage_events after the last calendar date", "n_after_window", "Removed: no date key exists.", "Resolved",
          "Rule checked; no events after the calendar."),
]


def clean_events(raw: DataFrame, users: DataFrame, calendar: DataFrame, cfg: AdoptionConfig = DEFAULT_CONFIG,
                 cut: Cut = _lazy) -> CleanResult:
    """users: the CLEAN users table (for the access-date rule); calendar: the
    clean calendar (its last date bounds the window)."""
    d = dedup_keep_first(standardize_columns(raw), "event_id", copies_col="_copies", cut=cut)
    ts = d.withColumn("_ts_raw", F.col("event_timestamp")).withColumn("event_timestamp", safe_timestamp("event_timestamp"))
    feat = blank_to_null(normalize_label(F.col("feature_name"), cfg.feature_names, cfg.feature_label_map))
    dur, mins = safe_double("session_duration_seconds"), safe_decimal("estimated_minutes_saved")
    false = F.lit(False)
    v = ts.select(
        "*", F.col("event_timestamp").isNotNull().alias("_dated"), F.to_date("event_timestamp").alias("_date"),
        _not_in(F.coalesce(F.col("feature_name"), F.lit("")), (*cfg.feature_names, "")).alias("_f_variant"),
        feat.alias("_feature"), (dur < 0).alias("_neg_dur"), (mins < 0).alias("_neg_min"), dur.alias("_dur"), mins.alias("_min"),
    )
    access = users.select(F.col("user_id").cast("string").alias("_user"), F.col("assigned_access_date").alias("_access"))
    j = v.join(access, v.user_id == access["_user"], "left").drop("_user")
    j = j.withColumn("_pre", F.coalesce(F.col("_date") < F.col("_access"), false))
    end = calendar.agg(F.max("date")).scalar()
    # without a last calendar date no event lies after it
    j = j.withColumn("_after", F.coalesce(~F.col("_pre") & (F.col("_date") > end), false))
    dated = F.col("_dated")
    metrics = {
        "n_dupe": _duplicates("event_id"),
        "n_bad_ts": F.count_if(~dated),
        "n_feature_variants": F.count_if(dated & F.col("_f_variant")),
        "n_missing_feature": F.count_if(dated & F.col("_feature").isNull()),
        "n_neg_duration": F.count_if(dated & F.coalesce(F.col("_neg_dur"), false)),
        "n_neg_minutes": F.count_if(dated & F.coalesce(F.col("_neg_min"), false)),
        "n_pre_access": F.count_if("_pre"),
        "n_no_access": F.count_if(dated & ~F.col("_pre") & F.col("_access").isNull()),
        "n_after_window": F.count_if("_after"),
    }

    def finish(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
        clean = flagged.where(dated & ~F.col("_pre") & ~F.col("_after")).select(
            "event_id", "user_id", "event_timestamp", "session_id", F.col("_feature").alias("feature_name"),
            strip("event_type").alias("event_type"), "prompt_category",
            to_bool("output_exported_flag").alias("output_exported_flag"),
            to_bool("successful_completion_flag").alias("successful_completion_flag"),
            F.when(~F.col("_neg_min"), F.col("_min")).alias("estimated_minutes_saved"),
            F.when(~F.col("_neg_dur"), F.col("_dur")).alias("session_duration_seconds"),
            to_bool("error_flag").alias("error_flag"), strip("platform").alias("platform"), "source_system",
            F.col("_access").isNull().alias("no_access_on_file"),
        )
        return clean, flagged.where(~dated).select("event_id", "user_id", F.col("_ts_raw").alias("event_timestamp_raw"))

    stages = {"dedup": d, "timestamps": ts, "flagged": j.where(dated)}
    return CleanResult(j, metrics, finish, (EVENT_ISSUES, "usage_events", 2), stages)


# --------------------------------------------------------------------------- feedback

FEEDBACK_ISSUES = [
    Issue("Duplicate feedback_id rows in feedback", "n_dupe", "Kept the first row of each feedback_id in ingest order.", "Resolved"),
    Issue("Unparseable feedback_timestamp in feedback", "n_bad_ts", "Quarantined.", "Resolved",
          "Rule checked; all timestamps parsed."),
    Issue("rating_1_to_5 outside 1-5 in feedback", "n_bad_rating", "Rating set to null; row kept.", "Resolved"),
    Issue("feature_name label variants in feedback", "n_feature_variants", "Mapped to canonical feature names.", "Resolved"),
    Issue("Missing feature_name in feedback", "n_missing_feature", "Kept null (general feedback).", "Accepted"),
    Issue("Missing free_text_feedback in feedback", "n_missing_text", "Kept null; not invented.", "Accepted"),
]


def clean_feedback(raw: DataFrame, cfg: AdoptionConfig = DEFAULT_CONFIG, cut: Cut = _lazy) -> CleanResult:
    d = dedup_keep_first(standardize_columns(raw), "feedback_id", copies_col="_copies", cut=cut)
    r = safe_double("rating_1_to_5")
    v = d.withColumn("_ts_raw", F.col("feedback_timestamp")).withColumn(
        "feedback_timestamp", safe_timestamp("feedback_timestamp"))
    v = v.select(
        "*", F.col("feedback_timestamp").isNotNull().alias("_dated"),
        r.alias("_rating"), (r.isNotNull() & ~r.between(1, 5)).alias("_bad_rating"),
        _not_in(F.coalesce(F.col("feature_name"), F.lit("")), (*cfg.feature_names, "")).alias("_f_variant"),
        blank_to_null(normalize_label(F.col("feature_name"), cfg.feature_names, cfg.feature_label_map)).alias("_feature"),
    )
    dated = F.col("_dated")
    metrics = {
        "n_dupe": _duplicates("feedback_id"),
        "n_bad_ts": F.count_if(~dated),
        "n_bad_rating": F.count_if(dated & F.col("_bad_rating")),
        "n_feature_variants": F.count_if(dated & F.col("_f_variant")),
        "n_missing_feature": F.count_if(dated & F.col("_feature").isNull()),
        "n_missing_text": F.count_if(dated & is_blank("free_text_feedback")),
    }

    def finish(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
        clean = flagged.where(dated).select(
            "feedback_id", "user_id", "feedback_timestamp",
            F.when(~F.col("_bad_rating"), F.col("_rating")).cast("int").alias("rating_1_to_5"),
            strip("sentiment_label").alias("sentiment_label"), strip("barrier_category").alias("barrier_category"),
            F.when(F.col("free_text_feedback") != "", F.col("free_text_feedback")).alias("free_text_feedback"),
            F.col("_feature").alias("feature_name"),
            to_bool("would_recommend_flag").alias("would_recommend_flag"),
        )
        return clean, flagged.where(~dated).select(
            "feedback_id", "user_id", F.col("_ts_raw").alias("feedback_timestamp_raw"))

    return CleanResult(v, metrics, finish, (FEEDBACK_ISSUES, "feedback", 3), {"dedup": d, "parsed": v.where(dated)})


# --------------------------------------------------------------------------- small tables

TRAINING_ISSUES = [
    Issue("training_sessions rows with attended > registered or completed > attended", "n_inconsistent",
          "Flagged for review; values kept.", "Accepted", "Rule checked; counts are consistent."),
]


def clean_training(raw: DataFrame, cfg: AdoptionConfig = DEFAULT_CONFIG) -> CleanResult:
    r = standardize_columns(raw)
    c = r.select(
        "training_session_id", safe_date("session_date").alias("session_date"),
        normalize_label(F.col("business_unit"), cfg.canonical_business_units, cfg.business_unit_label_map).alias("business_unit"),
        "training_format",
        *[safe_int(x).alias(x) for x in ("registered_count", "attended_count", "completion_count")],
        "facilitator", "session_topic",
    )
    metrics = {
        "n_inconsistent": F.count_if(F.col("attended_count") > F.col("registered_count"))
        + F.count_if(F.col("completion_count") > F.col("attended_count")),
        "attended_gt_registered": F.count_if(F.col("attended_count") > F.col("registered_count")),
        "completed_gt_attended": F.count_if(F.col("completion_count") > F.col("attended_count")),
    }
    out = CleanResult(c, metrics, lambda flagged: (flagged, None), (TRAINING_ISSUES, "training_sessions", 4))
    out.stages["counts"] = out.counts
    return out


def clean_features(raw: DataFrame) -> DataFrame:
    """CL-25: the feature catalog, typed; rows without a name are not features."""
    r = standardize_columns(raw)
    return r.where(~is_blank("feature_name")).select(
        strip("feature_id").alias("feature_id"), strip("feature_name").alias("feature_name"),
        strip("feature_category").alias("feature_category"), strip("target_persona").alias("target_persona"),
        safe_date("release_date").alias("release_date"), to_bool("core_feature_flag").alias("core_feature_flag"))


def clean_calendar(raw: DataFrame) -> DataFrame:
    r = standardize_columns(raw)
    return r.select(
        safe_date("date").alias("date"), safe_date("week_start_date").alias("week_start_date"),
        *[safe_int(x).alias(x) for x in ("week_number", "month")], "month_name",
        *[safe_int(x).alias(x) for x in ("quarter", "year")],
    )


def quality_summary(issues: DataFrame) -> DataFrame:
    """CL-20: number of findings and total affected records (not exclusive)."""
    return issues.agg(
        F.count(F.lit(1)).alias("total_findings"),
        F.coalesce(F.sum("affected_record_count"), F.lit(0)).cast("long").alias("total_affected_records"),
        F.count_if(F.col("status") == "Resolved").alias("resolved"),
        F.count_if(F.col("status") == "Accepted").alias("accepted"),
        F.count_if(F.col("status").startswith("Validated")).alias("validated"),
    )
