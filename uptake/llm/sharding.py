"""Uniform shuffle into shards of exact size, by a drawn communication matrix (DataFrame functions only).

Rows lie in ``P`` logical partitions (a power of two, of some thousand rows each). How many rows partition ``p`` sends
to shard ``s`` is drawn from the multivariate hypergeometric law with the partitions' sizes and the shards' exact
sizes as margins. The draw goes down a binary tree over partitions: at each node the shards' capacities are divided
between the two halves, shard by shard, by inverting the hypergeometric distribution function. Each partition then
permutes its rows and cuts them by its matrix row, the rows go to their shards, and each shard permutes again.

Permutations rank hashes inside slices of bounded size and add the sizes of the slices before, so no task holds a
whole shard.

Defined results: a null text has no bytes; repeated rows are placed one by one; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import pow2_at_least, unit
from uptake.session import materialize

SLICE = 8192  #: rows of a logical partition or a slice of a shard, about
REACH = 12.0  #: standard deviations around the mean that a draw looks at; less than 1e-25 of the mass lies beyond


def _ln_fact(n: Column) -> Column:
    """Natural logarithm of n!, by Stirling's series after a shift of ten."""
    def series(m: Column) -> Column:
        shift = sum((F.log(m - float(k)) for k in range(1, 10)), F.log(m))
        return (m + 0.5) * F.log(m) - m + 0.5 * math.log(2 * math.pi) + 1 / (12 * m) - 1 / (360 * m * m * m) - shift

    return _let(n + 10.0, series)


def _ln_choose(n: Column, k: Column) -> Column:
    return _ln_fact(n) - _ln_fact(k) - _ln_fact(n - k)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, where higher-order functions keep Spark from sharing it."""
    return F.transform(F.array(value), use)[0]


def hypergeometric(good: Column, total: Column, drawn: Column, u: Column) -> Column:
    """The number of ``good`` among ``drawn`` items out of ``total``, as the quantile at ``u``.

    The probability of the lowest looked-at value comes from log-factorials, the others by the ratio of neighbours.
    """
    low, high = F.greatest(F.lit(0).cast("long"), drawn + good - total), F.least(good, drawn)
    g, t, d = good.cast("double"), total.cast("double"), drawn.cast("double")
    mean = F.when(total > 0, d * g / t).otherwise(0.0)

    def around(m: Column) -> Column:
        sd = F.when(total > 1, F.sqrt(F.greatest(F.lit(0.0), m["mean"] * (1 - g / t) * (t - d) / (t - 1)))).otherwise(0.0)
        reach = REACH * sd + 3
        return F.struct(m["low"].alias("low"), m["high"].alias("high"),
                        F.greatest(m["low"], F.floor(m["mean"] - reach).cast("long")).alias("lo"),
                        F.least(m["high"], F.ceil(m["mean"] + reach).cast("long")).alias("hi"))

    def quantile(b: Column) -> Column:
        x = b["lo"].cast("double")
        first = F.exp(_ln_choose(g, x) + _ln_choose(t - g, d - x) - _ln_choose(t, d))

        def step(s: Column, k: Column) -> Column:
            kd = k.cast("double")
            nxt = s["p"] * (g - kd) * (d - kd) / ((kd + 1) * (t - g - d + kd + 1))
            return F.when(s["c"] < u, F.struct((k + 1).alias("x"), (s["c"] + nxt).alias("c"), nxt.alias("p"))).otherwise(s)

        ran = _let(first, lambda p: F.aggregate(
            F.when(b["hi"] > b["lo"], F.sequence(b["lo"], b["hi"] - 1)).otherwise(F.array().cast("array<long>")),
            F.struct(b["lo"].alias("x"), p.alias("c"), p.alias("p")), step))
        return F.when(b["high"] <= b["low"], b["low"]).otherwise(F.least(b["high"], ran["x"]))

    return _let(_let(F.struct(low.alias("low"), high.alias("high"), mean.alias("mean")), around), quantile)


def matrix(sizes: DataFrame, parts: int, shard_rows: list[int], seed: int = 0) -> DataFrame:
    """Rows ``(part, caps array<long>)``: how many rows each of the ``parts`` partitions sends to each shard.

    ``sizes`` holds ``(part, n)`` for ``part`` in 0 to ``parts - 1``, a power of two; missing ones have no rows.
    """
    spark = sizes.sparkSession
    shards = len(shard_rows)
    level = spark.range(1).select(F.col("id").alias("part"), F.array(*[F.lit(n).cast("long") for n in shard_rows]).alias("caps"))
    for k in range(parts.bit_length() - 2, -1, -1):
        left = (sizes.where(F.shiftright("part", k).bitwiseAND(F.lit(1)) == 0)
                .groupBy(F.shiftright("part", k + 1).alias("node")).agg(F.sum("n").alias("left_n")))
        node = level.join(left, level["part"] == left["node"], "left").select("part", "caps", F.coalesce("left_n", F.lit(0)).cast("long").alias("left_n"))
        total = F.aggregate("caps", F.lit(0).cast("long"), lambda s, x: s + x)

        def draw(s: Column, i: Column) -> Column:
            cap = F.element_at(F.col("caps"), i)
            drawn = F.struct(cap.alias("cap"), hypergeometric(cap, s["left"], s["want"], unit(F.lit(k), F.col("part"), i, seed=seed)).alias("got"))
            return _let(drawn, lambda g: F.struct((s["left"] - g["cap"]).alias("left"), (s["want"] - g["got"]).alias("want"),
                                                  F.concat(s["got"], F.array(g["got"])).alias("got")))

        got = F.aggregate(F.sequence(F.lit(1), F.lit(shards)),
                          F.struct(total.alias("left"), F.col("left_n").alias("want"), F.array().cast("array<long>").alias("got")),
                          draw)["got"]
        node = node.select("part", "caps", got.alias("got"))
        level = materialize(node.select(F.posexplode(F.array(
            F.col("got"), F.zip_with("caps", "got", lambda c, g: c - g))).alias("side", "caps"), "part")
            .select((F.col("part") * 2 + F.col("side")).alias("part"), "caps"), "matrix")
    return level


def uniform_shards(rows: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: a uniform shuffle, shard sizes at most one apart, slots gapless from 0.

    ``rows`` should be narrow: they are written once, to fix which row is which.
    """
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "shard-rows")
    n = rows.count()
    parts = pow2_at_least(-(-n // SLICE))
    placed = rows.withColumn("_part", F.pmod(F.xxhash64(F.lit(seed), F.lit("part"), "_row"), F.lit(parts)))
    sizes = materialize(placed.groupBy(F.col("_part").alias("part")).agg(F.count("*").alias("n")), "part-sizes")
    want = [n // shards + (s < n % shards) for s in range(shards)]
    drawn = matrix(sizes, parts, want, seed).select(F.col("part").alias("_part"), "caps")

    local = Window.partitionBy("_part").orderBy(F.xxhash64(F.lit(seed), F.lit("send"), "_row"), "_row")
    sent = placed.withColumn("_at", F.row_number().over(local).cast("long")).join(drawn, "_part")
    # the first shard whose running capacity reaches the row's place
    ran = F.aggregate("caps", F.struct(F.lit(0).alias("s"), F.lit(0).cast("long").alias("upto")),
                      lambda a, c: F.struct((a["s"] + (a["upto"] + c < F.col("_at")).cast("int")).alias("s"), (a["upto"] + c).alias("upto")))["s"]
    sent = materialize(sent.withColumn("shard", ran).drop("caps", "_at", "_part"), "sent")

    slices = pow2_at_least(-(-n // (shards * SLICE)))
    order = F.xxhash64(F.lit(seed), F.lit("keep"), "_row")
    kept = sent.withColumn("_slice", F.pmod(order, F.lit(slices)))
    counts = kept.groupBy("shard", "_slice").agg(F.count("*").alias("n"))
    before = counts.select("shard", "_slice", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_slice").orderBy(order, "_row")
    return (kept.withColumn("_in", F.row_number().over(inside) - 1).join(before, ["shard", "_slice"])
            .withColumn("slot", (F.col("_before") + F.col("_in")).cast("long")).drop("_slice", "_before", "_in", "_row"))
