"""Splittable CSV, keep-first by position, observed counts: SRC-1, CL-02, CL-19."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from uptake.operators.cleaning import dedup_keep_first
from uptake.sources import csv_records
from uptake.sources.csv_records import read_raw_csv


def records(n, seed=0):
    rng = random.Random(seed)
    pieces = ["plain", 'say "so"', "two\nlines", "carriage\r\nreturn", ",", "", "\n\n", "é\tü", " padded ", '"', "x" * 300]
    return [[str(i), "".join(rng.choice(pieces) for _ in range(rng.randrange(4))), rng.choice(["N/A", "7", "null", "a b"])] for i in range(n)]


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=end)
        w.writerow(["Row ID", "note", "flag"])
        w.writerows(rows)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield spark
    for k in keys:
        spark.conf.unset(k)


def expected(rows):
    na = set(csv_records.CSV_NA_TOKENS)
    return [tuple(None if v in na else v for v in r) for r in rows]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("sent", [True, False])
def test_quoted_line_ends_across_splits(small_splits, tmp_path, monkeypatch, end, sent):
    spark = small_splits
    if not sent:
        monkeypatch.setattr(csv_records, "MAX_SENT_SPLITS", 0)
    parts = [records(90, 1), records(70, 2), []]
    for i, rows in enumerate(parts):
        write(f"{tmp_path}/part-{i}.csv", rows, end)
    lines = csv_records._lines(spark, str(tmp_path))
    assert lines.rdd.getNumPartitions() > 8
    got = read_raw_csv(spark, str(tmp_path)).orderBy("ingest_seq").collect()
    # files in the order of their paths, records in the order of each file
    assert [(r["row_id"], r["note"], r["flag"]) for r in got] == expected(parts[0] + parts[1])
    assert len({r["ingest_seq"] for r in got}) == 160


def test_position_does_not_depend_on_splits(spark, tmp_path):
    write(f"{tmp_path}/a.csv", records(120, 3))
    whole = {r["row_id"]: r["ingest_seq"] for r in read_raw_csv(spark, str(tmp_path)).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert {r["row_id"]: r["ingest_seq"] for r in read_raw_csv(spark, str(tmp_path)).collect()} == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_files_without_quoted_line_ends_take_no_python(small_splits, tmp_path):
    write(f"{tmp_path}/a.csv", [[str(i), f"note {i}", "a, b"] for i in range(200)])
    df = read_raw_csv(small_splits, str(tmp_path))
    assert "MapInArrow" not in df._jdf.queryExecution().toString()
    assert [r["row_id"] for r in df.orderBy("ingest_seq").collect()] == [str(i) for i in range(200)]


def test_unterminated_quote_is_the_last_record_of_its_file(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,ok\n2,"open\nto the end\n' + "tail\n" * 400)
    (tmp_path / "b.csv").write_text("id,note\n3,next\n")
    got = {r["id"]: r["note"] for r in read_raw_csv(small_splits, str(tmp_path)).collect()}
    assert set(got) == {"1", "2", "3"} and got["2"].startswith("open\nto the end\ntail") and got["3"] == "next"


def test_empty_lines_and_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,note\n\n1,x\n   \n2,y\n")
    assert [r["id"] for r in read_raw_csv(spark, str(tmp_path)).orderBy("ingest_seq").collect()] == ["1", "2"]
    (tmp_path / "a.csv").write_text("id,note\n")
    assert read_raw_csv(spark, str(tmp_path)).collect() == []


def test_keep_first_is_a_hash_aggregation(spark):
    rows = spark.range(5000).select((F.col("id") % 40).cast("string").alias("k"), (F.lit(9999) - F.col("id")).alias("ingest_seq"),
                                    F.col("id").alias("payload"))
    rows = rows.union(spark.createDataFrame([(None, 3, 77), (None, 2, 78)], rows.schema))
    got = dedup_keep_first(rows, "k", copies_col="copies")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    by_key = {r["k"]: (r["payload"], r["copies"]) for r in got.collect()}
    assert by_key.pop(None) == (78, 2)
    assert by_key == {str(i): (4960 + i, 125) for i in range(40)}


def test_lines_are_counted_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note\n1,"x"\n2,"y\nz"\n3,"""q"""\n')
    lines = csv_records._lines(spark, str(tmp_path))
    assert [r[0] for r in lines.orderBy("id").select(csv_records._quotes("value")).collect()] == [0, 2, 1, 1, 6]
    got = read_raw_csv(spark, str(tmp_path)).drop("ingest_seq")
    assert {tuple(r) for r in got.collect()} == {("1", "x"), ("2", "y\nz"), ("3", '"q"')}
    (tmp_path / "a.csv").write_text('id,note\n1,"x"\n')
    # the table of the splits is read back, not made again
    assert "HashAggregate" not in read_raw_csv(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_moved_where_few_keys_repeat(spark):
    from uptake.session import materialize
    rows = spark.range(5000).select((F.col("id") % 4990).cast("string").alias("k"), F.col("id").alias("ingest_seq"))
    rows = rows.union(spark.createDataFrame([(None, 6000), (None, 6001)], rows.schema))
    got = dedup_keep_first(rows, "k", copies_col="copies", cut=materialize)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    by_key = {r["k"]: (r["ingest_seq"], r["copies"]) for r in got.collect()}
    assert by_key.pop(None) == (6000, 2)
    assert by_key == {str(i): (i, 2 if i < 10 else 1) for i in range(4990)}
