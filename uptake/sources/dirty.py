"""Deterministically dirtied, all-string copies of the bound tables.

They exercise the cleaning operators the way raw exports would (FIXTURES.md
§4): duplicate ids whose copies differ, unparseable timestamps and dates,
label variants, negative values, blanks, odd boolean spellings, events before
access or after the calendar. Every rule is a function of the row id, so the
SQL twin in :mod:`uptake.plans.clean_sql` reproduces it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake.tables import Tables

# The injected bad forms.
BAD_TIMESTAMPS = ("2026-13-45 99:99:99", "", "not_a_date", "00/00/0000")
BAD_DATES = ("2026-13-45", "", "not_a_date", "00/00/0000")
TRUE_SPELLINGS = ("True", "1", "YES", "true")
FALSE_SPELLINGS = ("false", "0", "no", "FALSE")


def _pick(values, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int") + 1)


def spell_bool(b: Column, k: Column) -> Column:
    return (
        F.when(b.isNull(), F.lit(None).cast("string"))
        .when(k % 89 == 5, F.lit("t"))
        .when(k % 89 == 6, F.lit(""))
        .when(b, _pick(TRUE_SPELLINGS, k % 4))
        .otherwise(_pick(FALSE_SPELLINGS, k % 4))
    )


def _dstr(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _tstr(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def label_dirt(f: Column, k: Column, blank_mod: int = 503) -> Column:
    return (
        F.when(f.isNull(), f)
        .when(k % blank_mod == 6, F.lit(""))
        .when(k % 53 == 7, F.lower(f))
        .when(k % 53 == 8, F.concat(f, F.lit(" ")))
        .when(k % 53 == 9, F.replace(f, F.lit(" and "), F.lit(" & ")))
        .when((k % 53 == 10) & (f == "Document Summarization"), F.lit("Doc Summarization"))
        .otherwise(f)
    )


def _with_copies(base: DataFrame, key: str, copy_changes: dict[str, Column]) -> DataFrame:
    copies = base.where(F.col(key).cast("long") % 250 == 0).withColumns(copy_changes).withColumn("ingest_seq", F.lit(1))
    return base.unionByName(copies)


def raw_users(t: Tables) -> DataFrame:
    u, k = t.users, F.col("user_id")
    bu = F.col("business_unit")
    base = u.select(
        k.cast("string").alias("user_id"),
        F.when(k % 53 == 7, F.lower(bu)).when(k % 53 == 8, F.concat(bu, F.lit(" ")))
        .when((k % 53 == 9) & (bu == "AUTOMOBILE"), F.lit("Auto"))
        .when(k % 53 == 10, F.lit("Unassigned Unit")).otherwise(bu).alias("business_unit"),
        F.when(k % 31 == 3, F.concat(F.lit("  "), F.col("role"), F.lit(" \t"))).otherwise(F.col("role")).alias("role"),
        "region", "manager_level",
        _dstr(F.col("hire_date")).alias("hire_date"),
        F.when((k % 997 >= 1) & (k % 997 <= 4), _pick(BAD_DATES, k % 997 - 1))
        .otherwise(_dstr(F.col("assigned_access_date"))).alias("assigned_access_date"),
        F.when(k % 89 == 11, F.lit("n/a")).otherwise(F.col("rollout_wave").cast("string")).alias("rollout_wave"),
        _dstr(F.col("training_assigned_date")).alias("training_assigned_date"),
        F.when((k % 61 == 7) & F.col("training_assigned_date").isNotNull(),
               _dstr(F.date_sub("training_assigned_date", 2)))
        .otherwise(_dstr(F.col("training_completed_date"))).alias("training_completed_date"),
        "training_format",
        spell_bool(F.col("manager_champion_flag"), k).alias("manager_champion_flag"),
        spell_bool(F.col("eligible_for_access_flag"), k).alias("eligible_for_access_flag"),
        F.lit(0).alias("ingest_seq"),
    )
    return _with_copies(base, "user_id", {"role": F.lit("Unknown Role")})


def raw_events(t: Tables) -> DataFrame:
    e, i = t.events, F.col("event_id")
    ts = (
        F.when(i % 401 == 8, F.col("event_timestamp") - F.expr("INTERVAL 30 DAYS"))
        .when(i % 809 == 9, F.col("event_timestamp") + F.expr("INTERVAL 60 DAYS"))
        .otherwise(F.col("event_timestamp"))
    )
    m, dur = F.col("estimated_minutes_saved").cast("string"), F.col("session_duration_seconds").cast("string")
    base = e.select(
        i.cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when((i % 997 >= 1) & (i % 997 <= 4), _pick(BAD_TIMESTAMPS, i % 997 - 1)).otherwise(_tstr(ts))
        .alias("event_timestamp"),
        "session_id",
        label_dirt(F.col("feature_name"), i).alias("feature_name"),
        F.when(i % 41 == 5, F.concat(F.lit("\n"), F.col("event_type"), F.lit("\t"))).otherwise(F.col("event_type")).alias("event_type"),
        "prompt_category",
        spell_bool(F.col("output_exported_flag"), i + 1).alias("output_exported_flag"),
        spell_bool(F.col("successful_completion_flag"), i).alias("successful_completion_flag"),
        F.when(i % 331 == 5, F.concat(F.lit("-"), m)).when(i % 29 == 3, F.concat(m, F.lit("5")))
        .when(m.isNotNull() & (i % 29 == 4), F.lit("0.004")).otherwise(m).alias("estimated_minutes_saved"),
        F.when(i % 331 == 6, F.concat(F.lit("-"), dur)).otherwise(dur).alias("session_duration_seconds"),
        spell_bool(F.col("error_flag"), i + 2).alias("error_flag"),
        F.when(i % 37 == 4, F.concat(F.col("platform"), F.lit(" "))).when(i % 37 == 5, F.concat(F.lit("\t"), F.col("platform")))
        .otherwise(F.col("platform")).alias("platform"),
        "source_system",
        F.lit(0).alias("ingest_seq"),
        _tstr(ts + F.expr("INTERVAL 1 HOURS")).alias("_copy_ts"),
    )
    return _with_copies(base, "event_id", {"event_timestamp": F.col("_copy_ts")}).drop("_copy_ts")


def raw_feedback(t: Tables) -> DataFrame:
    b, k = t.feedback, F.col("feedback_id")
    r = F.col("rating_1_to_5").cast("string")
    base = b.select(
        k.cast("string").alias("feedback_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(k % 997 == 1, F.lit("not_a_date")).otherwise(_tstr(F.col("feedback_timestamp"))).alias("feedback_timestamp"),
        F.when(k % 500 == 1, F.lit("0")).when(k % 500 == 2, F.lit("6")).when(k % 500 == 3, F.lit("-1"))
        .otherwise(r).alias("rating_1_to_5"),
        "sentiment_label",
        F.when(k % 71 == 3, F.concat(F.col("barrier_category"), F.lit(" \t"))).otherwise(F.col("barrier_category"))
        .alias("barrier_category"),
        F.when(F.col("free_text_feedback").isNull() & (k % 2 == 0), F.lit("")).otherwise(F.col("free_text_feedback"))
        .alias("free_text_feedback"),
        label_dirt(F.col("feature_name"), k, blank_mod=509).alias("feature_name"),
        spell_bool(F.col("would_recommend_flag"), k).alias("would_recommend_flag"),
        F.lit(0).alias("ingest_seq"),
    )
    return _with_copies(base, "feedback_id", {"rating_1_to_5": F.lit("3")})


def raw_training(t: Tables) -> DataFrame:
    s = F.col("training_session_id")
    return t.training.select(
        s.cast("string").alias("training_session_id"),
        _dstr(F.col("session_date")).alias("session_date"),
        F.when(s % 7 == 3, F.lower("business_unit")).otherwise(F.col("business_unit")).alias("business_unit"),
        "training_format",
        F.col("registered_count").cast("string").alias("registered_count"),
        F.col("attended_count").cast("string").alias("attended_count"),
        F.col("completion_count").cast("string").alias("completion_count"),
        "facilitator", "session_topic",
    )


def raw_calendar(t: Tables) -> DataFrame:
    c = t.calendar
    return c.select(
        _dstr(F.col("date")).alias("date"), _dstr(F.col("week_start_date")).alias("week_start_date"),
        *[F.col(x).cast("string").alias(x) for x in ("week_number", "month")], "month_name",
        *[F.col(x).cast("string").alias(x) for x in ("quarter", "year")],
    )


def raw_features(t: Tables) -> DataFrame:
    return t.features.select(*[F.col(c).cast("string").alias(c) for c in t.features.columns])


def export_raw(t: Tables, raw_dir: str) -> None:
    """All six raw tables as quoted CSV files. Later copies of a row lie in files that sort after those of the originals."""
    from uptake.jobs import RAW_FILES
    raw = {"users": raw_users(t), "events": raw_events(t), "feedback": raw_feedback(t), "training": raw_training(t),
           "calendar": raw_calendar(t), "features": raw_features(t)}
    for name, df in raw.items():
        df = df.withColumnRenamed("ingest_seq", "copy") if "ingest_seq" in df.columns else df.withColumn("copy", F.lit(0))
        (df.write.partitionBy("copy").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).csv(f"{raw_dir}/{RAW_FILES[name]}"))
