"""Exact percentiles without funnelling a group into one task.

``F.median`` / ``percentile`` merge every value of a group into one
aggregation buffer; for a segment holding a third of all users that is a
third of the table in one task. Here the exact answer is found in two passes
with bounded state:

1. a mergeable quantile sketch (``percentile_approx``, rank error <= n/A)
   brackets the target ranks of each group between two values lo..hi
   (groups of at most 4A values simply use their min..max);
2. only the values inside [lo, hi] are counted exactly, as (value, count)
   pairs -- at most a few n/A distinct values per group, ties collapsed -- and
   the target ranks are located in that short list with a running sum.

The result equals the exact linear-interpolation percentile (the definition
of SQL ``percentile_cont``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.operators.common import with_scalars


def exact_percentile(df: DataFrame, value: str, group: Sequence[str] = (), p: float = 0.5,
                     accuracy: int = 10_000, alias: str = "percentile") -> DataFrame:
    """One row per group: ``n`` (non-null values) and the exact percentile."""
    g = list(group)
    v = F.col(value)
    vals = df.where(v.isNotNull()).select(*g, v.cast("double").alias("_v"))
    # Sketch rank error is <= n/A. With a 4/A margin the bracket provably
    # covers both interpolation ranks once n > 4A; smaller groups use their
    # full [min, max] range, which is at most 4A values -- bounded either way.
    margin = 4.0 / accuracy
    lo_p, hi_p = max(0.0, p - margin), min(1.0, p + margin)
    stats = vals.groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("_v", F.array(F.lit(lo_p), F.lit(hi_p)), accuracy).alias("_b"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"),
    ).select(*g, "n", "_min", "_max",
             F.when((F.lit(lo_p) == 0.0) | (F.col("n") <= 4 * accuracy), F.col("_min"))
             .otherwise(F.col("_b")[0]).alias("_lo"),
             F.when((F.lit(hi_p) == 1.0) | (F.col("n") <= 4 * accuracy), F.col("_max"))
             .otherwise(F.col("_b")[1]).alias("_hi"))
    pos = (F.col("n") - 1) * F.lit(p)
    stats = stats.select(*g, "n", "_lo", "_hi", F.floor(pos).cast("long").alias("_r1"),
                         F.ceil(pos).cast("long").alias("_r2"), (pos - F.floor(pos)).alias("_frac"))
    keys = [*g, "n", "_r1", "_r2", "_frac"]  # all functionally dependent on the group
    j = vals.join(stats, g) if g else with_scalars(vals, stats)  # stats: one row per group
    # one aggregation: values below the bracket collapse into a single null-keyed
    # row; values inside it are counted per distinct value; values above are dropped
    cand = j.where(F.col("_v") <= F.col("_hi")).groupBy(
        *keys, F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_k")
    ).agg(F.count(F.lit(1)).alias("_c"))
    w = (Window.partitionBy(*g) if g else Window.partitionBy()).orderBy(F.asc_nulls_first("_k"))
    ranked = cand.withColumn("_end", F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    start = F.col("_end") - F.col("_c")

    def at(r):  # the 0-based rank r sits in the row with start <= r < end
        return F.min(F.when((start <= F.col(r)) & (F.col(r) < F.col("_end")), F.col("_k")))

    out = ranked.groupBy(*keys).agg(at("_r1").alias("_v1"), at("_r2").alias("_v2"))
    return out.select(
        *g, "n",
        (F.col("_v1") + (F.col("_v2") - F.col("_v1")) * F.col("_frac")).alias(alias),
    )
