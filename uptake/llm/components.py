"""Connected components of a link table, by alternating large-star and small-star rounds.

Each round is two grouped minima (combined map-side) and two equi-joins; a hub's links are spread by adaptive skew
splitting, because the side that carries its minimum has one row a node. Every round is written to the shared
checkpoint folder, so a lost executor costs a stage, not the run, and the plan stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.session import materialize


def _state(df: DataFrame) -> tuple:
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")).first()
    return r["n"], r["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge points from the larger to the smaller node here
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """Rows ``(node, component)`` for each node that has a link: the smallest node that its links reach.

    ``edges`` holds undirected links between integer nodes in the columns ``a`` and ``b``; repeated links, links in
    both directions and links of a node to itself are allowed, links with a null end are none. Nodes without links
    to others are absent from the result.
    """
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = materialize(e, "edges")
    before = _state(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        e = materialize(_small_star(_large_star(e)), "edges")
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
