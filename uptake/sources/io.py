"""Readers and writers of typed tables (SRC-2 ... SRC-4, SNK-1 ... SNK-5); raw CSV is read by ``csv_records``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.tables import Tables

TABLE_NAMES = ("users", "events", "feedback", "calendar", "features", "training")

# Typed schemas of the clean layer (FIXTURES.md §1).
CLEAN_SCHEMAS = {
    "users": "user_id string, business_unit string, role string, region string, manager_level string, "
             "hire_date date, assigned_access_date date, rollout_wave int, training_assigned_date date, "
             "training_completed_date date, training_format string, manager_champion_flag boolean, "
             "eligible_for_access_flag boolean",
    "events": "event_id string, user_id string, event_timestamp timestamp_ntz, session_id string, "
              "feature_name string, event_type string, prompt_category string, output_exported_flag boolean, "
              "successful_completion_flag boolean, estimated_minutes_saved decimal(18,6), session_duration_seconds double, "
              "error_flag boolean, platform string, source_system string",
    "feedback": "feedback_id string, user_id string, feedback_timestamp timestamp_ntz, rating_1_to_5 int, "
                "sentiment_label string, barrier_category string, free_text_feedback string, "
                "feature_name string, would_recommend_flag boolean",
    "calendar": "date date, week_start_date date, week_number int, month int, month_name string, "
                "quarter int, year int",
    "features": "feature_id string, feature_name string, feature_category string, target_persona string, "
                "release_date date, core_feature_flag boolean",
    "training": "training_session_id string, session_date date, business_unit string, training_format string, "
                "registered_count int, attended_count int, completion_count int, facilitator string, "
                "session_topic string",
}


def load_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> Tables:
    """SRC-2: the six clean tables, typed (parquet, or CSV with the fixed schema)."""
    def one(name):
        if fmt == "csv":
            return spark.read.schema(CLEAN_SCHEMAS[name]).option("header", True).csv(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")
    return Tables(**{n: one(n) for n in TABLE_NAMES})


def write_events(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Events partitioned by event date, so date filters prune files.

    The upstream plan is partitioned by user, so every task holds every day;
    written as is, each task would leave one small file per day. The
    ``rebalance`` hint shuffles by day and lets AQE size the write tasks
    (``advisoryPartitionSizeInBytes``): small days are coalesced and a heavy
    day is split over several tasks, so each day gets a few right-sized files.
    """
    (events.withColumn("event_date", F.to_date("event_timestamp"))
     .hint("rebalance", "event_date")
     .write.mode(mode).partitionBy("event_date").parquet(path))


def write_tables(t: Tables, base: str, mode: str = "overwrite") -> None:
    """SNK-1/3/4: idempotent overwrite; events partitioned by event date."""
    for name in TABLE_NAMES:
        df = getattr(t, name)
        if name == "events":
            write_events(df, f"{base}/{name}", mode)
        else:
            df.write.mode(mode).parquet(f"{base}/{name}")


def write_issue_log(issues: DataFrame, path: str) -> None:
    """SNK-2: the issue log is a handful of rows; one file is the useful shape."""
    issues.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_issue_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: read a written issue log back with its types."""
    return spark.read.schema(
        "table_order int, issue_order int, table_name string, issue_type string, affected_record_count long, "
        "resolution string, status string").option("header", True).csv(path)


def event_sample(events: DataFrame, n: int, seed: int = 42, key: str = "event_id") -> DataFrame:
    """SNK-5: a reproducible exact-size sample, sorted by time.

    Rows are ranked by the MD5 of the seed and the key; ``limit`` after ``orderBy``
    is planned as a distributed top-k (each task keeps n rows), so this never
    sorts or collects the whole table.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return events.orderBy(h, F.col(key)).limit(n).orderBy("event_timestamp", key)
