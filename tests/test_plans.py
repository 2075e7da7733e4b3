"""Plan shape of the headline queries as they would run at scale.

Automatic broadcast is off, so data-sized joins plan as shuffle joins; the
checks then hold for any input size: no cartesian or nested-loop joins, scans
of the wide tables read only the columns used, and the number of distinct events scan nodes
stays at its designed value. Single-metric queries read the events once (plus
the as-of-date scalar subquery where they need it); composite reports whose
branches use different summary columns read them a few times (the batch
report job materialises the summary instead). The cached calendar's own
timestamp-only scan is not counted: it runs once per session.
"""

import re

import pytest

from bench import HEADLINE
from tests.conftest import SF_SMALL
from uptake.plans.catalog import REGISTRY


def _final_tree(df) -> str:
    ep = df._jdf.queryExecution().executedPlan()
    try:
        return ep.finalPhysicalPlan().treeString()
    except Exception:  # not adaptive
        return ep.treeString()


@pytest.fixture(scope="module")
def no_auto_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


# distinct events scans allowed (default 1: one shared pass)
MAX_EVENT_SCANS = {"barrier_ranking": 0, "dormancy_by_segment": 2, "segment_scorecard": 0,  # reads the summary it wrote
                   "headline_kpis": 1}


@pytest.mark.parametrize("key", HEADLINE)
def test_headline_plan_shape(no_auto_broadcast, key):
    spark = no_auto_broadcast
    df = REGISTRY[key][0](spark, SF_SMALL)
    df.collect()
    p = _final_tree(df)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    scans = set(re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*/events\.parquet", p))
    scans = {c for c in scans if not re.fullmatch(r"ts#\d+", c)}  # the cached calendar's bounds scan
    assert len(scans) <= MAX_EVENT_SCANS.get(key, 1), scans
    # column pruning reaches the scans of the wide tables (customer, orders, supplier)
    for table in ("customer", "orders", "supplier"):
        all_cols = set(spark.read.parquet(f"{SF_SMALL}/{table}.parquet").columns)
        for cols in re.findall(rf"FileScan parquet \[([^\]]*)\][^\n]*/{table}\.parquet", p):
            assert set(re.sub(r"#\d+L?", "", cols).split(",")) < all_cols, (table, cols)
