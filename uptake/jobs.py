"""Batch jobs: clean raw exports, publish the star schema, compute the report tables.

    python -m uptake.jobs clean   --raw DIR --out DIR
    python -m uptake.jobs star    --clean DIR --out DIR
    python -m uptake.jobs reports --clean DIR --out DIR

``clean`` reads the raw CSV exports (all strings), runs the cleaning
pipelines and writes typed parquet plus the issue log. The clean users table
feeds the events pipeline (access-date rule), so it is materialised once in
the cluster's checkpoint folder instead of being recomputed inside the events
plan; every write is an idempotent overwrite, so a rerun after a lost
executor or a failed job produces the same output.
"""

from __future__ import annotations

import argparse
from contextlib import contextmanager

from pyspark.sql import SparkSession

from uptake.config import AdoptionConfig, DEFAULT_CONFIG
from uptake.operators import cleaning as cl
from uptake.operators import activity, reports, retention, star, value
from uptake.operators.common import precompute
from uptake.session import ensure_checkpoint_dir, materialize
from uptake.sources.csv_records import read_raw_csv
from uptake.sources.io import load_tables, write_issue_log, write_tables
from uptake.sources.publish import current, publish, read_current
from uptake.tables import Tables

RAW_FILES = {"users": "users", "events": "usage_events", "feedback": "feedback", "training": "training_sessions",
             "features": "feature_catalog", "calendar": "calendar"}


@contextmanager
def short_methods(spark: SparkSession):
    """The JVM interprets methods of over 8000 bytes for ever: stages that would be one run as their single operators."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_cleaning(spark: SparkSession, raw_dir: str, out_dir: str, cfg: AdoptionConfig = DEFAULT_CONFIG) -> Tables:
    """CL-26: clean all six raw tables and write them (events partitioned by day).

    Raw files are parsed once, into the staging tables that all later steps read. Each table's flagged rows are written
    once, and the counts of the quality log are observed in that pass.
    """
    ensure_checkpoint_dir(spark)
    with short_methods(spark):
        _clean(spark, raw_dir, out_dir, cfg)
    return load_tables(spark, out_dir)


def _clean(spark: SparkSession, raw_dir: str, out_dir: str, cfg: AdoptionConfig) -> None:
    def raw(name):
        return materialize(read_raw_csv(spark, f"{raw_dir}/{RAW_FILES[name]}"), f"staging_{name}")

    def cut(repeated):
        return materialize(repeated, "repeated_keys")

    calendar = materialize(cl.clean_calendar(raw("calendar").drop("ingest_seq")), "clean_calendar")
    features = cl.clean_features(raw("features").drop("ingest_seq"))
    users, _, user_log = cl.clean_users(raw("users"), cfg, cut).written("flagged_users")
    events, bad_events, event_log = cl.clean_events(raw("events"), users, calendar, cfg, cut).written("flagged_events")
    feedback, bad_feedback, feedback_log = cl.clean_feedback(raw("feedback"), cfg, cut).written("flagged_feedback")
    training, _, training_log = cl.clean_training(raw("training").drop("ingest_seq"), cfg).written("flagged_training")
    t = Tables(users=users, events=events.drop("no_access_on_file"), feedback=feedback, calendar=calendar,
               features=features, training=training)
    write_tables(t, out_dir)
    bad_events.write.mode("overwrite").parquet(f"{out_dir}/quarantine_events")
    bad_feedback.write.mode("overwrite").parquet(f"{out_dir}/quarantine_feedback")
    issues = (user_log.unionByName(event_log).unionByName(feedback_log).unionByName(training_log)
              .orderBy("table_order", "issue_order"))
    write_issue_log(issues, f"{out_dir}/data_quality_issues")


def load_star(spark: SparkSession, t: Tables, out_dir: str) -> dict:
    """SNK-4: the star schema of clean tables as one transaction; returns the manifest.

    Key maps of the version before are extended by new members, all dimensions, facts and key maps are written to a new
    version, and it becomes the current one only if no key, foreign key or not-null rule is broken;
    ``publish.PublishError`` leaves the old version as it is. Facts of events are partitioned by date key.
    """
    known = read_current(spark, out_dir) if current(spark, out_dir) else None
    maps = {n: materialize(m, n) for n, m in star.key_maps(t, known).items()}
    return publish(spark, out_dir, {**maps, **star.keyed_star(t, maps)}, check=star.violations,
                   partition_by={"fact_usage_events": ["date_key"]})


def run_star(spark: SparkSession, clean_dir: str, out_dir: str) -> dict:
    """Publish the star schema of the clean layer under ``out_dir``."""
    ensure_checkpoint_dir(spark)
    return load_star(spark, load_tables(spark, clean_dir), out_dir)


REPORTS = {
    "weekly_insights": reports.weekly_insights, "segment_scorecard": reports.segment_scorecard,
    "feature_scorecard": reports.feature_scorecard, "barrier_matrix": reports.barrier_matrix,
    "wau_matrix": reports.wau_matrix, "adoption_funnel": reports.adoption_funnel,
    "headline_kpis": reports.headline_kpis, "retention_cohorts": retention.retention_cohorts,
    "dormancy_by_segment": retention.dormant_users, "dormancy_trend": retention.dormancy_trend,
    "wau_by_segment": lambda t, cfg: activity.weekly_active_users(t, cfg, "business_unit"),
    "time_saved_by_feature": value.time_saved_by_feature,
}


def run_reports(spark: SparkSession, clean_dir: str, out_dir: str, cfg: AdoptionConfig = DEFAULT_CONFIG) -> None:
    """Write every report table. The per-(user, day) event summary that all
    event metrics share is written once to the checkpoint folder first, so
    the reports read it instead of re-scanning and re-shuffling the events
    (and a lost executor costs a re-read, not a re-aggregation)."""
    t = precompute(load_tables(spark, clean_dir), cfg)
    for name, fn in REPORTS.items():
        fn(t, cfg).write.mode("overwrite").parquet(f"{out_dir}/{name}")


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="uptake.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean")
    c.add_argument("--raw", required=True)
    c.add_argument("--out", required=True)
    for name in ("star", "reports"):
        r = sub.add_parser(name)
        r.add_argument("--clean", required=True)
        r.add_argument("--out", required=True)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"uptake-{a.cmd}").getOrCreate()
    from uptake.session import JOB_CONF
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    if a.cmd == "clean":
        run_cleaning(spark, a.raw, a.out)
    elif a.cmd == "star":
        run_star(spark, a.clean, a.out)
    else:
        run_reports(spark, a.clean, a.out)


if __name__ == "__main__":
    main()
