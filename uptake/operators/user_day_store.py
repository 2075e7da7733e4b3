"""The user-day summary as a stored table that is kept up to date day by day (SNK-3).

The summary of ``common.user_day_rows`` is written once, partitioned by date. A refresh lists the files of the clean
events (names, sizes and times only, no contents) and compares each day's fingerprint with the one that the stored day
was computed from. Only days that differ are read, by partition pruning, and only their partitions are overwritten.
The fingerprints are written last: a refresh that fails is done again, with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.operators.common import known_users, user_day_rows
from uptake.tables import Tables

DAY = r"event_date=(\d{4}-\d{2}-\d{2})"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def day_versions(spark: SparkSession, events_path: str) -> DataFrame:
    """Per day of the clean events ``(date, version)``: a fingerprint of its files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(events_path)
    day = F.to_date(F.nullif(F.regexp_extract("path", DAY, 1), F.lit("")))
    return files.select(day.alias("date"), F.xxhash64("path", "length", "modificationTime").alias("h")).where(
        "date IS NOT NULL").groupBy("date").agg(F.bit_xor("h").alias("version"))


def refresh_user_day(spark: SparkSession, events_path: str, store: str, cfg: AdoptionConfig = DEFAULT_CONFIG) -> list:
    """Brings the stored summary up to date with the events under ``events_path`` (partitioned by ``event_date``).

    Returns the days that were computed anew or removed: one date each, so no more than the calendar has. A store must
    be refreshed with one configuration only.
    """
    schema = "date date, version long"
    # listed before the events are read: a file that comes in between makes its day differ at the next refresh
    now = {r["date"]: r["version"] for r in day_versions(spark, events_path).collect()}
    known = {r["date"]: r["version"] for r in spark.read.schema(schema).parquet(f"{store}/days").collect()} if _exists(
        spark, f"{store}/days") else {}
    changed = sorted(d for d, v in now.items() if known.get(d) != v)
    gone = sorted(d for d in known if d not in now)
    if changed:
        events = spark.read.parquet(events_path).where(F.col("event_date").isin(changed))
        rows = user_day_rows(events, cfg).withColumn("day", F.col("date"))
        rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(f"{store}/data")
    for d in gone:
        _delete(spark, f"{store}/data/day={d}")
    if changed or gone:
        spark.createDataFrame(sorted(now.items()), schema).coalesce(1).write.mode("overwrite").parquet(f"{store}/days")
    return changed + gone


def stored_user_day(spark: SparkSession, t: Tables, store: str) -> Tables:
    """``t`` with the stored summary in place of a pass over its events."""
    rows = spark.read.parquet(f"{store}/data").drop("day")
    return t.replace(user_day=known_users(rows, t), user_day_stored=True)
