"""Raw CSV -> clean -> star: persisted keys, atomic publication, checks (SNK-3, SNK-4, ST-01 ... ST-11)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from uptake import jobs
from uptake.operators import star
from uptake.operators.keys import extend_key_map, numbered
from uptake.plans.catalog import CFG, tables
from uptake.sources import dirty
from uptake.sources.publish import PublishError, current, prune, publish, read_current


def test_numbers_follow_the_order_over_partitions(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("name")).repartition(13)
    got = numbered(rows, ["name"], "n", 5).collect()
    assert {(r["name"], r["n"]) for r in got} == {(i, i + 5) for i in range(1000)}


def test_keys_survive_a_reload_with_a_member_that_sorts_first(spark):
    one = spark.createDataFrame([("b",), ("c",), (None,), ("b",)], "name string")
    first = extend_key_map(one, ["name"], "key")
    two = spark.createDataFrame([("a",), ("c",), ("d",)], "name string")
    second = extend_key_map(two, ["name"], "key", first)
    assert {tuple(r) for r in second.collect()} == {("b", 1), ("c", 2), ("a", 3), ("d", 4)}
    assert extend_key_map(two, ["name"], "key", second).exceptAll(second).count() == 0


def test_published_tables_change_together(spark, tmp_path):
    base = f"{tmp_path}/out"
    table = lambda n: {"x": spark.range(n).toDF("x"), "y": spark.range(2 * n).toDF("y")}
    with pytest.raises(FileNotFoundError):
        read_current(spark, base)
    assert publish(spark, base, table(3))["number"] == 1
    reader = read_current(spark, base)
    with pytest.raises(PublishError, match="bad"):
        publish(spark, base, table(5), check=lambda tabs: ["bad"] if tabs["x"].count() == 5 else [])
    assert read_current(spark, base)["y"].count() == 6 and current(spark, base)["number"] == 1

    def fails(tabs):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError, match="lost"):
        publish(spark, base, table(5), check=fails)
    assert read_current(spark, base)["y"].count() == 6
    assert publish(spark, base, table(4))["number"] == 2
    # a reader that opened the old version keeps it, new ones see the new
    assert reader["x"].count() == 3 and read_current(spark, base)["x"].count() == 4

    def meanwhile(tabs):  # another run publishes first
        publish(spark, base, table(9))
        return []
    with pytest.raises(PublishError, match="another run"):
        publish(spark, base, table(7), check=meanwhile)
    assert read_current(spark, base)["x"].count() == 9
    assert len(prune(spark, base, keep=1)) == 2 and read_current(spark, base)["y"].count() == 18


def test_csv_to_star(spark, tmp_path):
    raw, clean, out = f"{tmp_path}/raw", f"{tmp_path}/clean", f"{tmp_path}/star"
    dirty.export_raw(tables(spark, SF_SMALL), raw)
    t = jobs.run_cleaning(spark, raw, clean, CFG)
    # users without a calendar day of access break a foreign key, and nothing is published
    t.calendar.where("date > '2024-01-03'").write.parquet(f"{tmp_path}/short/calendar")
    short = t.replace(calendar=spark.read.parquet(f"{tmp_path}/short/calendar"))
    with pytest.raises(PublishError, match="dim_date"):
        jobs.load_star(spark, short, out)
    assert current(spark, out) is None
    assert jobs.run_star(spark, clean, out)["number"] == 1
    tabs = read_current(spark, out)
    assert star.violations(tabs) == []
    facts = tabs["fact_usage_events"]
    assert {"prompt_category", "output_exported_flag", "error_flag", "source_system"} <= set(facts.columns)
    assert facts.count() == t.events.join(t.users, "user_id", "left_semi").count()
    assert facts.where("prompt_category IS NOT NULL AND source_system IS NOT NULL AND error_flag IS NOT NULL").count() > 0
    before = {r["user_id"]: r["user_key"] for r in tabs["dim_user"].collect()}
    # a reload keeps every key; a new unit that sorts first gets the next one
    more = t.users.limit(1).withColumn("user_id", F.lit("new")).withColumn("business_unit", F.lit("AAA"))
    jobs.load_star(spark, t.replace(users=t.users.unionByName(more)), out)
    again = read_current(spark, out)
    after = {r["user_id"]: r["user_key"] for r in again["dim_user"].collect()}
    assert {u: k for u, k in after.items() if u != "new"} == before and after["new"] == max(before.values()) + 1
    units = {r["business_unit_name"]: r["business_unit_key"] for r in again["dim_business_unit"].collect()}
    assert units["AAA"] == max(units.values()) and star.violations(again) == []


def test_checks_read_each_fact_once(spark):
    t = tables(spark, SF_SMALL)
    tabs = star.star(t)
    for check in (star.null_violations, star.fk_violations):
        scans = [line for line in check(tabs)._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and "events.parquet" in line]
        facts = [line for line in scans if "user_id" in line]
        assert len(facts) == 1, scans


def test_key_rules_see_what_is_wrong(spark):
    t = tables(spark, SF_SMALL)
    tabs = star.star(t)
    assert star.violations(tabs) == []
    tabs["dim_business_unit"] = tabs["dim_business_unit"].where("business_unit_key > 1")
    tabs["fact_feedback"] = tabs["fact_feedback"].withColumn("date_key", F.lit(None).cast("int"))
    tabs["dim_role"] = tabs["dim_role"].union(tabs["dim_role"])
    wrong = star.violations(tabs)
    assert any(w.startswith("dim_user.business_unit_key") for w in wrong)
    assert any(w.startswith("fact_feedback.date_key") and "nulls" in w for w in wrong)
    assert any(w.startswith("dim_role.role_key") for w in wrong)
