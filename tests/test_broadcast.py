"""Explicit broadcasts happen only behind the row-count check."""

from uptake.operators.common import bounded_broadcast, fits_broadcast


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounded_broadcast_respects_the_bound(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")  # only explicit hints may broadcast
    try:
        big = spark.range(1000)
        small, large = spark.range(3), spark.range(10)
        assert fits_broadcast(small, max_rows=3) and not fits_broadcast(large, max_rows=3)
        hinted = big.join(bounded_broadcast(small, max_rows=3), "id")
        unhinted = big.join(bounded_broadcast(large, max_rows=3), "id")
        assert "BroadcastHashJoin" in _plan(hinted)
        assert "BroadcastHashJoin" not in _plan(unhinted) and "SortMergeJoin" in _plan(unhinted)
        assert hinted.count() == 3 and unhinted.count() == 10
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
