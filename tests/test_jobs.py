"""The cleaning job end to end: raw CSV exports in, typed tables + log out."""

import tempfile

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from uptake.jobs import run_cleaning, run_reports
from uptake.plans.catalog import CFG, cleaned, tables
from uptake.sources import dirty


def test_run_cleaning_from_csv_matches_in_memory_pipeline(spark):
    t = tables(spark, SF_SMALL)
    raw_dir, out_dir, rep_dir = (tempfile.mkdtemp(prefix=p) for p in ("uptake-raw-", "uptake-clean-", "uptake-rep-"))
    dirty.export_raw(t, raw_dir)
    out = run_cleaning(spark, raw_dir, out_dir, CFG)
    mem = cleaned(spark, SF_SMALL)
    assert out.users.count() == mem["users"].clean.count()
    assert out.events.count() == mem["events"].clean.count()
    assert out.feedback.count() == mem["feedback"].clean.count()
    assert spark.read.parquet(f"{out_dir}/quarantine_feedback").count() == mem["feedback"].quarantine.count() > 0
    assert out.events.agg(F.sum("estimated_minutes_saved")).first() == mem["events"].clean.agg(F.sum("estimated_minutes_saved")).first()
    from uptake.sources.io import read_issue_log
    log = read_issue_log(spark, f"{out_dir}/data_quality_issues")
    mem_log = mem["users"].issues.unionByName(mem["events"].issues).unionByName(mem["feedback"].issues) \
        .unionByName(mem["training"].issues)
    got = sorted((r.issue_type, int(r.affected_record_count)) for r in log.collect())
    want = sorted((r.issue_type, r.affected_record_count) for r in mem_log.collect())
    assert got == want
    run_reports(spark, out_dir, rep_dir, CFG)
    # reports written from the precomputed user-day summary equal the lazy plans over the events
    from uptake.jobs import REPORTS
    from uptake.sources.io import load_tables
    lazy = load_tables(spark, out_dir)
    for name in ("weekly_insights", "segment_scorecard", "dormancy_trend", "headline_kpis"):
        got, want = spark.read.parquet(f"{rep_dir}/{name}"), REPORTS[name](lazy, CFG)
        assert got.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
