"""Streaming forms of the row-local event operators.

X-1  dedup by event id within a watermark (at-least-once telemetry);
X-2  row-local cleaning reused from the batch expressions; clean, quarantined
     and late rows written per micro-batch by ``foreachBatch``;
X-3  tumbling Monday-aligned weekly active users per segment, approximate
     distinct, finalised when the watermark passes the week.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.functions import blank_to_null, normalize_label, safe_decimal, safe_double, safe_timestamp, strip, to_bool
from uptake.session import ensure_checkpoint_dir


def dedup_stream(events: DataFrame, delay: str = "1 hour", ts: str = "event_timestamp") -> DataFrame:
    """X-1: drop repeated event ids; state for an id is kept until the
    watermark (max event time - delay) passes its first copy."""
    # watermarks need TIMESTAMP (zoned); sessions are pinned to UTC, so the
    # cast keeps the wall-clock value of the TIMESTAMP_NTZ column.
    return (events.withColumn("_event_time", F.col(ts).cast("timestamp"))
            .withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["event_id"]).drop("_event_time"))


def clean_stream(raw: DataFrame, cfg: AdoptionConfig = DEFAULT_CONFIG) -> DataFrame:
    """X-2: typed, normalised columns plus ``_valid`` (timestamp parsed)."""
    mins, dur = safe_decimal("estimated_minutes_saved"), safe_double("session_duration_seconds")
    return raw.select(
        "event_id", "user_id", safe_timestamp("event_timestamp").alias("event_timestamp"),
        F.col("event_timestamp").alias("event_timestamp_raw"),
        blank_to_null(normalize_label(F.col("feature_name"), cfg.feature_names, cfg.feature_label_map)).alias("feature_name"),
        strip("event_type").alias("event_type"),
        to_bool("successful_completion_flag").alias("successful_completion_flag"),
        F.when(mins >= 0, mins).alias("estimated_minutes_saved"),
        F.when(dur >= 0, dur).alias("session_duration_seconds"),
    ).withColumn("_valid", F.col("event_timestamp").isNotNull())


def week_end(ts: str = "event_timestamp"):
    """The instant at which the Monday-start week of an event is over."""
    return F.date_trunc("week", F.col(ts)) + F.expr("INTERVAL 7 DAYS")


def _watermark(state: DataFrame, epoch_id: int, delay: str):
    """The latest event time of the epochs before this one, less the delay; None before the first dated event."""
    last = state.where(F.col("epoch_id") < epoch_id).agg(
        (F.max("latest") - F.expr(f"INTERVAL {delay}")).alias("watermark")).first()
    return last["watermark"] if last else None


def split_writer(clean_path: str, quarantine_path: str, late_path: str | None = None, state_path: str | None = None,
                 delay: str = "1 day") -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: valid, quarantined and late rows go to separate tables.

    A row is late if its week was over at the watermark: the latest event time of all earlier epochs less ``delay``,
    the rule by which ``weekly_active_stream`` with that delay no longer counts a week. Late rows are written to
    ``late_path`` with the watermark that they missed, all others to ``clean_path``, so weekly counts of the clean table
    are complete and what they lack is on record. ``state_path`` keeps one row an epoch, its latest event time; both
    are given together, without them no row is late.

    Idempotent per micro-batch: each epoch overwrites its own ``epoch_id=N`` folder, so a batch that is replayed after
    a failure replaces its first attempt, state included, and meets the same watermark again. Readers see ``epoch_id``
    as a partition column.
    """
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()  # all sinks read it; it is computed once
        try:
            valid = batch.where("_valid").drop("_valid", "event_timestamp_raw")
            if late_path is not None:
                # this epoch's own row first: the table then exists, and a replay finds what it found before
                batch.agg(F.max("event_timestamp").alias("latest")).coalesce(1).write.mode("overwrite") \
                    .parquet(f"{state_path}/epoch_id={epoch_id}")
                watermark = _watermark(spark.read.parquet(state_path), epoch_id, delay)
                mark = F.lit(watermark).cast("timestamp_ntz")
                is_late = F.coalesce(week_end() <= mark, F.lit(False))
                valid.where(is_late).withColumn("watermark", mark).write.mode("overwrite").parquet(f"{late_path}/epoch_id={epoch_id}")
                valid = valid.where(~is_late)
            valid.write.mode("overwrite").parquet(f"{clean_path}/epoch_id={epoch_id}")
            batch.where(~F.col("_valid")).select("event_id", "user_id", "event_timestamp_raw") \
                .write.mode("overwrite").parquet(f"{quarantine_path}/epoch_id={epoch_id}")
        finally:
            batch.unpersist()
    return write


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint location for a streaming query, under the shared folder the
    cluster names in ``spark.checkpoint.dir`` (a local scratch folder only in
    local mode; see ``session.ensure_checkpoint_dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def weekly_active_stream(events: DataFrame, users: DataFrame, cfg: AdoptionConfig = DEFAULT_CONFIG,
                         segment: str = "business_unit", delay: str = "1 day") -> DataFrame:
    """X-3: approximate WAU per Monday-start week and segment.

    The stream-static join attaches the segment (users is a batch table);
    7-day windows start on Mondays because the epoch is a Thursday
    (startTime = 4 days). Rows past the watermark are dropped from the
    aggregate state; read the clean table of ``split_writer`` and none are,
    because those are in its late table.
    """
    ev = events.where(F.col("event_type").isin(*cfg.meaningful_event_types))
    j = ev.join(users.select("user_id", segment), "user_id")
    return (
        j.withColumn("_event_time", F.col("event_timestamp").cast("timestamp"))
        .withWatermark("_event_time", delay)
        .groupBy(F.window("_event_time", "7 days", startTime="4 days").alias("week"), segment)
        .agg(F.approx_count_distinct("user_id").alias("weekly_active_users"))
        .select(F.col("week.start").cast("date").alias("week_start_date"), segment, "weekly_active_users")
    )
