"""SRC-1: quoted CSV read in parallel, with a global ingest position.

A CSV record may hold line ends inside quotes, so a split of a file cannot tell by itself whether it begins inside a
quoted text; reading such files whole, one task a file, does not scale. Here the files are read as lines in ordinary
splits, twice:

1. The quotes and lines of each split are counted (one narrow aggregate). Prefix sums over the splits of a file, one row
   a split, tell which splits begin inside quotes, and over all splits the position of each split's first line.
2. Lines whose quotes are balanced so far are whole records. Where some are not, one Arrow step runs along the lines of
   a split and joins those of a record; what crosses the border of a split comes out as fragments, at most two a split,
   which an aggregation joins. If no line of the input has unbalanced quotes, lines are records and the step is left out.

Records are then parsed by ``from_csv``. ``ingest_seq`` is the place of the record's first line in all files, in the
order of their paths: a long that depends on neither the size of the splits nor their order of processing.

Quotes inside quoted text are doubled, and a quote opens only at the start of a field (RFC 4180). Empty lines between
records are none. Of files that end inside quotes the rest is one last record.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uptake.config import CSV_NA_TOKENS
from uptake.session import materialize

#: splits whose table is sent to every task; beyond it the lines are shuffled to their split's row
MAX_SENT_SPLITS = 1_000_000
SPLIT = ["file", "start", "length"]
CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "mode": "PERMISSIVE"}

JOINED = pa.schema([("record", pa.string()), ("pos", pa.int64()), ("continued", pa.bool_()), ("open", pa.bool_()),
                    ("header", pa.bool_())])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("lineSep", "\n").text(path)
    return df.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"), F.monotonically_increasing_id().alias("id"))


def _quotes(value: str) -> Column:
    """Quotes of a text: the bytes that it loses without them."""
    return F.octet_length(value) - F.octet_length(F.replace(F.col(value), F.lit('"'), F.lit("")))


def split_table(lines: DataFrame) -> DataFrame:
    """One row a split: its first line's id and position, its lines, and whether it begins inside quotes."""
    q = _quotes("value")
    stats = lines.groupBy(*SPLIT).agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("lines"), F.sum(q).alias("quotes"),
        F.count_if(q % 2 == 1).alias("unbalanced"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return stats.select(
        *SPLIT, "first_id", "lines", "unbalanced",
        (F.coalesce(F.sum("quotes").over(inside), F.lit(0)) % 2).cast("int").alias("state"),
        F.coalesce(F.sum("lines").over(before), F.lit(0)).alias("base"))


def _placed(lines: DataFrame, splits: DataFrame, sent: bool) -> DataFrame:
    """Lines in the order of their split, with its row; a split that the table does not know ends the job."""
    s = splits.select(*SPLIT, "first_id", "lines", "state", "base")
    j = lines.join(F.broadcast(s) if sent else s, SPLIT, "left")
    at = F.col("id") - F.col("first_id")
    known = F.coalesce((at >= 0) & (at < F.col("lines")), F.lit(False))
    if not sent:
        j = j.repartition(*SPLIT).sortWithinPartitions(*SPLIT, "id")
    return j.select("value", F.when(known, F.col("base") + at).otherwise(
        F.raise_error(F.lit("the splits of the input changed while it was read")).cast("long")).alias("pos"),
        ((F.col("start") == 0) & (at == 0)).alias("header"), F.col("base").alias("split"), F.col("state"))


def _join_lines(batches: Iterator[pa.RecordBatch], border: bool) -> Iterator[pa.RecordBatch]:
    """Whole records, those of several lines joined; with ``border`` the marked fragments of records that cross the border
    of a split instead."""
    split, state, held, first = None, 0, [], None

    def row(open_end):
        return "\n".join(held), first[0], first[2], open_end, first[1]

    for batch in batches:
        value, pos, header, where, begins = (batch.column(c) for c in ("value", "pos", "header", "split", "state"))
        where, begins, heads, places = where.to_numpy(), begins.to_numpy(), header.to_numpy(zero_copy_only=False), pos.to_numpy()
        odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False).astype(np.int64) & 1
        rows, single = [], np.zeros(len(odd), dtype=bool)
        for lo, hi in _stretches(where):
            fresh = False
            if split is None or where[lo] != split:
                if held:
                    rows.append(row(True))
                split, state, held = int(where[lo]), int(begins[lo]), []
                fresh = state == 1  # the first lines belong to a record of an earlier split
            after = (state + np.cumsum(odd[lo:hi])) & 1
            single[lo:hi] = (after == 0) & (odd[lo:hi] == 0)  # begins and ends outside quotes
            inside = lo + np.flatnonzero(~single[lo:hi])
            for i, text, ends in zip(inside.tolist(), value.take(pa.array(inside)).to_pylist(), (after[inside - lo] == 0).tolist()):
                if not held:
                    first = int(places[i]), bool(heads[i]), fresh
                    fresh = False
                held.append(text)
                if ends:
                    rows.append(row(False))
                    held = []
            state = int(after[-1])
        out = [r for r in rows if (r[2] or r[3]) == border]
        if out:
            yield _records(out)
        if not border and single.any():
            keep = pa.array(single)
            none = pa.array(np.zeros(int(single.sum()), bool))
            yield pa.RecordBatch.from_arrays([value.filter(keep), pos.filter(keep), none, none, header.filter(keep)], schema=JOINED)
    if held and border:
        yield _records([row(True)])


def _stretches(where: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if not len(where):
        return []
    cuts = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(where)]
    return list(zip(cuts, cuts[1:]))


def _records(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), JOINED)], schema=JOINED)


def _stitched(placed: DataFrame) -> DataFrame:
    """Whole records: those of one split, and the fragments of the others put together."""
    whole, pieces = (placed.mapInArrow(partial(_join_lines, border=b), "record string, pos long, continued boolean, open boolean, header boolean")
                     for b in (False, True))
    # at most two fragments a split; a record's number is that of its first fragment, in the order of positions
    along = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pieces = pieces.withColumn("group", F.sum((~F.col("continued")).cast("long")).over(along))
    put = pieces.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("pos", "record"))).alias("parts"), F.max("header").alias("header"))
    return whole.select("record", "pos", "header").union(
        put.select(F.array_join(F.transform("parts", lambda p: p["record"]), "\n"), F.col("parts")[0]["pos"], "header"))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``(record, pos)`` of all files under ``path``, without their header lines and empty lines."""
    lines = _lines(spark, path)
    splits = materialize(split_table(lines), "csv-splits")  # the lines are counted once
    size = splits.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("unbalanced"), F.lit(0)).alias("unbalanced")).first()
    placed = _placed(lines, splits, size["n"] <= MAX_SENT_SPLITS)
    if size["unbalanced"]:
        records = _stitched(placed)
    else:
        records = placed.select(F.col("value").alias("record"), "pos", "header")
    records = records.where("not header").select(F.regexp_replace("record", "\r$", "").alias("record"), "pos")
    return records.where(F.trim("record") != "")


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first line: trimmed, lower-cased, spaces to underscores."""
    line = spark.read.option("lineSep", "\n").text(path).first()
    names = next(csv.reader([line[0].rstrip("\r").lstrip("﻿")]), []) if line else []
    return [c.strip().lower().replace(" ", "_") for c in names]


def read_raw_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Every column as string, NA tokens as null, and ``ingest_seq``. No schema inference."""
    names = columns or header_of(spark, path)
    if not names:
        raise ValueError(f"no header line under {path}")
    schema = ", ".join(f"`{c}` string" for c in names)
    row = F.from_csv("record", F.lit(schema), CSV_OPTIONS)
    parsed = csv_records(spark, path).select(row.alias("r"), F.col("pos").alias("ingest_seq"))
    return parsed.select(
        *[F.when(~F.col(f"r.{c}").isin(*CSV_NA_TOKENS), F.col(f"r.{c}")).alias(c) for c in names], "ingest_seq")
