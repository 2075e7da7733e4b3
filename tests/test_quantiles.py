from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from uptake.operators.quantiles import exact_percentile


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40).map(lambda x: x / 4)), min_size=1,
                max_size=300),
       st.sampled_from([0.5, 0.25, 0.9]))
def test_matches_exact_percentile(spark, rows, p):
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.percentile for r in exact_percentile(df, "x", ["g"], p=p, accuracy=50).collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.percentile("x", p).alias("m")).collect()}
    assert set(got) == set(want)
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9, (k, got[k], want[k])


def test_hot_group_and_ties(spark):
    rows = [("hot", float(i % 97)) for i in range(30000)] + [("cold", 1.0), ("cold", 4.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.percentile for r in exact_percentile(df, "x", ["g"], accuracy=2000).collect()}
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("x").alias("m")).collect()}
    assert got == want
