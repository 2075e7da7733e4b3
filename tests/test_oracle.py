"""Every registered query equals its DuckDB oracle (the driver's gate)."""

import pytest

from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle import compare, duck
from uptake.plans.catalog import REGISTRY

KEYS = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    fn, sql = REGISTRY[key]
    df = fn(spark, SF_ORACLE)
    if sql is None:
        assert df.count() >= 0
        return
    ok, msg = compare(df, con, sql)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "weekly_active_users" in df.columns
    assert set(e.oracle_sql()) <= set(e.queries())


def test_small_scale_runs(spark):
    con = duck(SF_SMALL)
    for key in ("weekly_insights", "segment_scorecard", "quality_issue_log", "retention_cohorts"):
        fn, sql = REGISTRY[key]
        ok, msg = compare(fn(spark, SF_SMALL), con, sql)
        assert ok, f"{key}: {msg}"


def test_result_types_match_oracle(spark, con):
    """Same column types on both engines (the driver compares schemas too)."""
    import scripts.check_types as ct
    diffs = {}
    for key, (fn, sql) in REGISTRY.items():
        if sql is None:
            continue
        s = {f.name: ct.cat_spark(f.dataType) for f in fn(spark, SF_ORACLE).schema.fields}
        rel = con.sql(sql)
        d = {c: ct.cat_duck(t) for c, t in zip(rel.columns, rel.types)}
        if s != d:
            diffs[key] = {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
    assert not diffs, diffs
