"""Late rows, day pruning, the stored user-day summary, known users, and what the plans read."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.test_truth_cases import CFG as TRUTH_CFG
from tests.test_truth_cases import ev, make, user
from uptake.operators import activity, expectations, reports, star, value
from uptake.operators.common import user_day_activity
from uptake.operators.user_day_store import refresh_user_day, stored_user_day
from uptake.plans.catalog import CFG, tables
from uptake.sources.io import load_tables, write_tables
from uptake.streaming.events import clean_stream, split_writer, stream_checkpoint, weekly_active_stream

T = dt.datetime
SUMMARY = ("user_id", "date", "n_events", "n_meaningful", "minutes_meaningful", "first_value_ts")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def event_scans(df) -> set[str]:
    """Different scans of the raw events, but for that of the cached calendar's bounds."""
    df.collect()
    final = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().treeString()
    return {c for c in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*/events\.parquet", final) if not re.fullmatch(r"ts#\d+", c)}


# ---------------------------------------------------------------- late rows

def test_late_rows_are_logged_and_weekly_counts_lack_only_them(spark, tmp_path):
    users = spark.createDataFrame([("a", "Ops"), ("b", "Ops"), ("c", "Ops")], "user_id string, business_unit string")
    schema = ("event_id string, user_id string, event_timestamp string, feature_name string, event_type string, "
              "successful_completion_flag string, estimated_minutes_saved string, session_duration_seconds string")
    def row(i, u, ts): return (i, u, ts, None, "prompt_submitted", "true", None, "1")  # noqa: E704
    batches = [
        [row("1", "a", "2024-01-02 10:00:00"), row("2", "b", "2024-01-08 00:30:00")],
        [row("3", "c", "2024-01-07 23:00:00"), row("4", "a", "2024-01-17 09:00:00")],  # 3 is old, but its week is still open
        [row("5", "b", "2024-01-03 08:00:00"), row("6", "b", "2024-01-16 08:00:00"), row("7", "c", "no time")],  # 5 is past the watermark
    ]
    src, out = f"{tmp_path}/src", f"{tmp_path}/out"
    ck = stream_checkpoint(spark, str(tmp_path).replace("/", "-"))
    sink = split_writer(f"{out}/clean", f"{out}/quarantine", f"{out}/late", f"{out}/state", delay="1 day")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        clean_stream(spark.readStream.schema(schema).parquet(src), CFG).writeStream.foreachBatch(sink) \
            .option("checkpointLocation", f"{ck}/split").trigger(availableNow=True).start().awaitTermination()
    late = spark.read.parquet(f"{out}/late").collect()
    assert [(r["event_id"], r["watermark"], r["epoch_id"]) for r in late] == [("5", T(2024, 1, 16, 9), 2)]
    assert [r["event_id"] for r in spark.read.parquet(f"{out}/quarantine").collect()] == ["7"]
    # a replay of the last batch meets the same watermark and changes nothing
    sink(clean_stream(spark.createDataFrame(batches[2], schema), CFG), 2)
    assert spark.read.parquet(f"{out}/late").count() == 1
    clean = spark.read.parquet(f"{out}/clean")
    weekly_active_stream(spark.readStream.schema(clean.schema).parquet(f"{out}/clean"), users, CFG).writeStream \
        .format("memory").queryName("weekly_late").outputMode("complete").option("checkpointLocation", f"{ck}/weekly") \
        .trigger(availableNow=True).start().awaitTermination()
    got = {(r["week_start_date"], r["weekly_active_users"]) for r in spark.table("weekly_late").collect()}
    week = F.to_date(F.date_trunc("week", "event_timestamp"))
    assert got == {(r["w"], r["n"]) for r in clean.groupBy(week.alias("w")).agg(F.count_distinct("user_id").alias("n")).collect()}
    assert got == {(dt.date(2024, 1, 1), 2), (dt.date(2024, 1, 8), 1), (dt.date(2024, 1, 15), 2)}


def test_weekly_stream_equals_batch_counts(spark, tmp_path):
    t = tables(spark, SF_SMALL)
    t.events.write.parquet(f"{tmp_path}/events")
    users = t.users
    weekly_active_stream(spark.readStream.schema(t.events.schema).parquet(f"{tmp_path}/events"), users, CFG).writeStream \
        .format("memory").queryName("weekly_all").outputMode("complete") \
        .option("checkpointLocation", stream_checkpoint(spark, str(tmp_path).replace("/", "-"))).trigger(availableNow=True).start().awaitTermination()
    got = {(r["week_start_date"], r["business_unit"], r["weekly_active_users"]) for r in spark.table("weekly_all").collect()}
    want = {(r["week_start_date"], r["business_unit"], r["weekly_active_users"])
            for r in activity.weekly_active_users(t, CFG, "business_unit").collect()}
    assert {g for g in got if g[1] is not None} == want


# ---------------------------------------------------------------- the clean layer, by day

@pytest.fixture(scope="module")
def clean_layer(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("clean"))
    write_tables(tables(spark, SF_SMALL), base)
    return base


def test_trailing_window_prunes_days(spark, clean_layer):
    t = load_tables(spark, clean_layer)
    fixed = activity.mau_trailing(t, CFG.with_(as_of_date="2024-01-20"))
    scan = next(line for line in plan_of(fixed).split("\n") if "FileScan" in line and "clean" in line and "/events" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ > 2024-01-13[^\]]*event_date#\d+ <= 2024-01-20", scan), scan
    assert "event_timestamp" not in scan.split("PartitionFilters")[0]
    open_ended = activity.mau_trailing(t, CFG)
    assert "dynamicpruning" in plan_of(open_ended).lower() or re.search(r"PartitionFilters: \[[^\]]*event_date#\d+[^\]]*[Ss]ubquery", plan_of(open_ended))
    assert open_ended.collect() == activity.mau_trailing(tables(spark, SF_SMALL), CFG).collect()


def test_refresh_rewrites_only_the_days_that_changed(spark, clean_layer, tmp_path):
    t = load_tables(spark, clean_layer)
    events, store = f"{tmp_path}/events", f"{tmp_path}/store"
    from uptake.sources.io import write_events
    last = t.events.agg(F.max("event_date")).first()[0]
    rows = t.events.drop("event_date")
    write_events(rows.where(F.to_date("event_timestamp") < last), events)
    assert len(refresh_user_day(spark, events, store, CFG)) > 5
    assert refresh_user_day(spark, events, store, CFG) == []
    before = {r["path"]: r["modificationTime"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{store}/data").select("path", "modificationTime").collect()}
    write_events(rows.where(F.to_date("event_timestamp") == last), events, "append")
    assert refresh_user_day(spark, events, store, CFG) == [last]
    after = {r["path"]: r["modificationTime"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{store}/data").select("path", "modificationTime").collect()}
    assert {p for p in after if after[p] != before.get(p)} == {p for p in after if f"day={last}" in p} and set(before) <= set(after)
    got, want = stored_user_day(spark, t, store).user_day.select(*SUMMARY), user_day_activity(t, CFG).select(*SUMMARY)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # a day whose events are gone goes
    rows.where(F.to_date("event_timestamp") != last).withColumn("event_date", F.to_date("event_timestamp")).write.mode("overwrite") \
        .partitionBy("event_date").parquet(events)
    assert last in refresh_user_day(spark, events, store, CFG)
    assert stored_user_day(spark, t, store).user_day.where(F.col("date") == last).count() == 0


# ---------------------------------------------------------------- D19, and what is read

def test_users_that_nobody_knows_are_in_no_metric(spark):
    t = make(spark, [user("u1"), user("u2", bu=None)], [
        ev("1", "u1", T(2024, 1, 2, 9), mins="10"), ev("2", "ghost", T(2024, 1, 2, 9), mins="99"), ev("3", "u2", T(2024, 1, 2, 9)),
        ev("4", "ghost", T(2024, 1, 9, 9), "output_generated", mins="5"), ev("5", "u1", T(2024, 1, 9, 9), "output_generated", mins="7.125")])
    company = {r["week_number"]: r["weekly_active_users"] for r in activity.weekly_active_users(t, TRUTH_CFG).collect()}
    assert company == {1: 2, 2: 1}
    insight = {r["week_number"]: r["pct_of_company_wau_this_week"] for r in reports.weekly_insights(t, TRUTH_CFG).collect()}
    share = {r["week_number"]: r["pct_of_company_wau"] for r in activity.wau_share(t, TRUTH_CFG).collect()}
    assert insight == share == {1: 50.0, 2: 100.0}
    saved = {r["feature_name"]: r["total_estimated_minutes_saved"] for r in value.time_saved_by_feature(t, TRUTH_CFG).collect()}
    assert saved["Knowledge Search"] == 17.0
    assert activity.mau_trailing(t, TRUTH_CFG).first()["monthly_active_users"] == 2


def test_reports_read_the_events_as_often_as_stated(spark):
    t = tables(spark, SF_SMALL)
    # the summary was written by a pass of its own when the report was built
    assert len(event_scans(reports.segment_scorecard(t, CFG))) == 0
    assert len(event_scans(reports.headline_kpis(t, CFG))) <= 1
    assert len(event_scans(expectations.expectations_report(t, CFG))) <= 2
    assert len(event_scans(star.null_violations(star.star(t)))) == 1
    assert len(event_scans(star.fk_violations(star.star(t)))) == 1


def test_raw_events_are_aggregated_before_they_are_joined(spark):
    t = tables(spark, SF_SMALL)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        for df in (activity.weekly_active_users(t, CFG, "business_unit"), reports.feature_usage_matrix(t, CFG), reports.feature_scorecard(t, CFG)):
            lines = plan_of(df).split("\n")
            for i, line in enumerate(lines):
                if "FileScan" in line and "/events.parquet" in line:
                    above = [x for x in lines[:i] if len(x) - len(x.lstrip(" :|+-*()0123456789")) < len(line)]
                    names = [re.search(r"[A-Z]\w+", x).group(0) for x in reversed(above) if re.search(r"[A-Z]\w+", x)]
                    first = next(n for n in names if n in ("Exchange", "HashAggregate", "SortAggregate", "SortMergeJoin"))
                    assert first == "HashAggregate", names[:6]
    finally:
        for k in keys:
            spark.conf.unset(k)
