"""The one-pass dormancy trend equals the direct two-branch definition:
activated users (activation_users) minus those active in each week's
trailing window (trailing_active_by_week)."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_ORACLE
from uptake.operators.activity import trailing_active_by_week
from uptake.operators.population import activation_users
from uptake.operators.retention import dormancy_trend
from uptake.plans.catalog import CFG, tables


def _direct(t, cfg, cols):
    act = activation_users(t, cfg).where(F.col("activated")).select("user_id", *cols)
    for c in cols:
        act = act.where(F.col(c).isNotNull())
    base = act.groupBy(*cols).agg(F.count(F.lit(1)).alias("activated_users"))
    active = trailing_active_by_week(t, cfg).join(act, "user_id").groupBy("week_number", *cols).agg(
        F.count(F.lit(1)).alias("a"))
    weeks = sorted(r.week_number for r in t.calendar.select("week_number").distinct().collect())  # a few weeks
    grid = base.withColumn("week_number", F.explode(F.array(*[F.lit(w) for w in weeks])))
    return grid.join(active, ["week_number", *cols], "left").select(
        "week_number", *cols, "activated_users", (F.col("activated_users") - F.coalesce("a", F.lit(0))).alias("dormant_users"))


@pytest.mark.parametrize("cols", [[], ["business_unit"]])
@pytest.mark.parametrize("boundary", ["date", "instant"])
def test_one_pass_trend_matches_direct_definition(spark, cols, boundary):
    t = tables(spark, SF_ORACLE)
    cfg = CFG.with_(activation_boundary=boundary)
    got = dormancy_trend(t, cfg, cols or None).select("week_number", *cols, "activated_users", "dormant_users")
    want = _direct(t, cfg, cols)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
