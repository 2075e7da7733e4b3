"""Exact duplicates by content sort.

Texts are equal when they are identical without white space. Rows are range-partitioned at sampled splitters by the
first bytes of the normalised text, sorted by Spark's external sort, and every text is compared in full with its
neighbour. Splitters hold no whole texts: beyond ``LEAD`` bytes the order goes on by SHA-256, then by the rank of the
row among its copies, so that a splitter is small and a group of any size is cut over as many partitions as its rows
need. Where two partitions meet, the last text of the one is compared in full with the first text of the other, and
runs that go on are counted as one; the driver sees none of this, the stitching table has one row for each partition.

Of a group the longest original text stays, then the smallest identifier.

Defined results: a null text counts as empty, and empty texts are equal; a row without identifier stays only if no
equal row of that length has one; of repeated rows (same identifier and text) one stays; an empty table gives no rows;
extra columns are ignored by ``duplicates`` and handed on, whatever their names, by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from uptake.llm.common import shuffle_parts, text_of
from uptake.session import materialize

#: white space that is deleted before texts are compared
SPACE = r"[\x20\x09-\x0D]+"
LEAD = 32  #: bytes of a normalised text that a splitter holds

FIRST, LAST = 1, 2  #: marks of the rows at the ends of a partition


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the runs of equal texts of a sorted partition; the texts at its two ends are handed on."""
    run, before, held = -1, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        norm = batch.column("norm")
        same = pc.equal(norm.slice(1), norm.slice(0, len(norm) - 1)).to_numpy(zero_copy_only=False)
        starts = np.r_[before is None or norm[0].as_py() != before, ~same.astype(bool)]
        runs = run + np.cumsum(starts)
        run, last = int(runs[-1]), norm[len(norm) - 1].as_py()
        if held is not None:
            yield _out(*held)
        held = (batch.drop_columns(["norm"]), runs, starts, norm[0].as_py() if before is None else None, None)
        before = last
    if held is not None:
        yield _out(*held[:4], before)


def _out(batch, runs, starts, first, last) -> pa.RecordBatch:
    ends, edge = np.zeros(len(runs), np.int32), [None] * len(runs)
    if first is not None:
        ends[0] |= FIRST
        edge[0] = first
    if last is not None:
        ends[-1] |= LAST
        edge[-1] = last
    names = [*batch.schema.names, "run", "starts", "ends", "edge"]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs, pa.int64()), pa.array(starts, pa.bool_()),
                                       pa.array(ends, pa.int32()), pa.array(edge, pa.binary())], names=names)


def _sorted_runs(docs: DataFrame, payload) -> DataFrame:
    """Rows ``(payload, doc_id, sha, part, run, starts, ends, edge)`` of the content sort, written to the shared folder."""
    spark = docs.sparkSession
    rows = docs.select(
        *([payload.alias("payload")] if payload is not None else []),
        F.col("doc_id").cast("long").alias("doc_id"), F.char_length(text_of("text")).alias("chars"),
        F.regexp_replace(text_of("text"), SPACE, "").cast("binary").alias("norm"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("norm", 256)))
    keys = [F.substring("norm", 1, LEAD), F.col("sha"), F.desc("chars"), F.asc_nulls_last("doc_id")]
    # the row's place tells repeated rows apart, so that they too can lie on both sides of a splitter
    laid = rows.repartitionByRange(shuffle_parts(spark), *keys, F.monotonically_increasing_id())
    laid = laid.sortWithinPartitions(keys[0], F.col("sha"), F.col("norm"), *keys[2:]).drop("chars").withColumn(
        "part", F.spark_partition_id())
    schema = StructType.fromDDL("run long, starts boolean, ends int, edge binary")
    kept = [f for f in laid.schema if f.name != "norm"]
    return materialize(laid.mapInArrow(_runs, StructType([*kept, *schema])), "content-sort")


def _stitched(placed: DataFrame) -> DataFrame:
    """Per partition that has rows: ``(part, goes_on, base)``; a run's number in the whole sort is ``base + run``."""
    ends = placed.where("ends > 0").select("part", "run", "ends", "edge")
    order = Window.orderBy("part")  # one row for each partition of the sort
    parts = ends.groupBy("part").agg((F.max("run") + 1).alias("runs")).withColumn("previous", F.lag("part").over(order))
    first = ends.where(F.col("ends").bitwiseAND(FIRST) > 0).select("part", F.col("edge").alias("first_text"))
    last = ends.where(F.col("ends").bitwiseAND(LAST) > 0).select(F.col("part").alias("previous"), F.col("edge").alias("last_text"))
    met = parts.join(first, "part").join(last, "previous", "left").select(
        "part", "runs", F.coalesce(F.col("first_text") == F.col("last_text"), F.lit(False)).alias("goes_on"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return met.select("part", "goes_on", (
        F.sum("runs").over(upto) - F.col("runs") - F.sum(F.col("goes_on").cast("long")).over(upto)).alias("base"))


def _judged(placed: DataFrame) -> DataFrame:
    """The rows of the sort with ``keep_id``, ``group_size`` and ``kept``."""
    runs = placed.groupBy("part", "run").agg(F.count("*").alias("n"), F.max(F.when(F.col("starts"), F.col("doc_id"))).alias("head"))
    runs = runs.join(_stitched(placed), "part").select(
        "part", "run", "n", "head", (F.col("base") + F.col("run")).alias("group"),
        ((F.col("run") > 0) | ~F.col("goes_on")).alias("opens"))
    groups = runs.groupBy("group").agg(F.sum("n").alias("group_size"), F.max(F.when(F.col("opens"), F.col("head"))).alias("keep_id"))
    # a key of this join holds no more rows than one partition of the sort, however large the group
    return placed.join(runs.join(groups, "group").select("part", "run", "opens", "group_size", "keep_id"), ["part", "run"]).withColumn(
        "kept", F.col("starts") & F.col("opens"))


def duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``(doc_id, keep_id, group_size, kept, text_sha256)``."""
    return _judged(_sorted_runs(docs, None)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return _judged(_sorted_runs(docs, F.struct(*docs.columns))).where("kept").select("payload.*")
