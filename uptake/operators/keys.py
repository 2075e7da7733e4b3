"""Surrogate keys that stay the same between loads (ST-01, ST-02, ST-05).

A dimension's key map holds every member that was ever loaded, with its key. A load adds the members that the map does
not know, by an anti join, and numbers them after the largest key so far. New members are range-sorted by their natural
key and numbered by partition: the rows of each partition are counted, prefix sums over the partitions give each its
first number, and rows take the next numbers in place. No window runs over the members themselves, so a load of
hundreds of millions of new users is as parallel as its sort.

Members that a load no longer has keep their key; rows that refer to them stay valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.session import materialize

ROW_BITS = 33  #: bits of ``monotonically_increasing_id`` that count the rows of a partition


def numbered(rows: DataFrame, order: list[str], number: str, first: int = 1) -> DataFrame:
    """``rows`` with consecutive numbers from ``first`` in the order of ``order`` (nulls first)."""
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    # written once, so that the counts and the rows are those of one and the same partitioning
    ids = materialize(ids, "numbered").withColumn("_part", F.shiftright("_id", ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = ids.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(  # one row for each partition of the sort
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return ids.join(base, "_part").select(*rows.columns, (F.col("_base") + within + F.lit(first)).alias(number))


def extend_key_map(members: DataFrame, natural: list[str], key: str, known: DataFrame | None = None) -> DataFrame:
    """The key map ``(natural..., key long)`` with the members that ``known`` lacks added.

    Members with a null natural key get none. ``members`` may hold a member many times.
    """
    present = F.lit(True)
    for c in natural:
        present = present & F.col(c).isNotNull()
    members = members.where(present).select(*natural).distinct()
    if known is None:
        return numbered(members, natural, key)
    new = members.join(known.select(*natural), natural, "left_anti")
    last = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("last")).first()["last"]
    return known.select(*natural, F.col(key).cast("long").alias(key)).unionByName(numbered(new, natural, key, last + 1))
