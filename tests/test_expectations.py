"""E-2 / E-4 checks fire on bad data and pass on good data."""

from uptake.operators.expectations import row_count_failures, values_outside


def test_values_outside_canonical_set_ignores_nulls(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,), ("bogus",), ("a",)], "c string")
    assert values_outside(df, "c", ("A", "B")).collect()[0].failures == 2  # 'bogus' and case-variant 'a'


def test_row_count_bounds(spark):
    df = spark.range(5)
    assert row_count_failures(df, (1, None)).collect()[0].failures == 0
    assert row_count_failures(df, (1, 4)).collect()[0].failures == 1
    assert row_count_failures(df, (5, 5)).collect()[0].failures == 0
    assert row_count_failures(spark.range(0), (1, None)).collect()[0].failures == 1


def test_required_columns_reports_missing(spark):
    from uptake.operators.expectations import required_columns
    df = spark.createDataFrame([(1, "a")], "user_id long, business_unit string")
    assert required_columns(df, ["user_id", "business_unit"]) == []
    assert required_columns(df, ["user_id", "role", "rollout_wave"]) == ["role", "rollout_wave"]
