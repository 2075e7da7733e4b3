import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from uptake.config import BUSINESS_UNIT_LABEL_MAP, CANONICAL_BUSINESS_UNITS
from uptake.functions import normalize_label, pct1, safe_date, safe_timestamp, to_bool


def test_to_bool_spellings(spark):
    vals = ["True", "false", "1", "0", "YES", "no", "t", "", None, " yes "]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(to_bool("v").alias("b"))
    assert [r.b for r in df.collect()] == [True, False, True, False, True, False, None, None, None, True]


def test_normalize_label(spark):
    vals = ["RETAIL BANKING", "retail  banking", "Tech", " Operations ", "Risk & Compliance", "Mystery", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(
        normalize_label(F.col("v"), CANONICAL_BUSINESS_UNITS, BUSINESS_UNIT_LABEL_MAP).alias("n"))
    assert [r.n for r in df.collect()] == ["Retail Banking", "Retail Banking", "Technology", "Operations",
                                          "Risk and Compliance", "Mystery", "", None]


def test_strict_parsers(spark):
    df = spark.createDataFrame([("2026-01-05", "2026-01-05 10:00:00"), ("2026-1-5", "2026-13-45 99:99:99"),
                                ("not_a_date", "00/00/0000")], "d string, t string")
    rows = df.select(safe_date("d").alias("d"), safe_timestamp("t").alias("t")).collect()
    assert rows[0].d is not None and rows[0].t is not None
    assert all(r.d is None and r.t is None for r in rows[1:])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(1, 5000)), min_size=1, max_size=20))
def test_pct1_is_exact_half_up(spark, pairs):
    from decimal import ROUND_HALF_UP, Decimal
    pairs = [(min(a, b), b) for a, b in pairs]
    df = spark.createDataFrame(pairs, "a long, b long").select(pct1("a", "b").alias("p"))
    got = [r.p for r in df.collect()]
    want = [float((Decimal(100 * a) / Decimal(b)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP)) for a, b in pairs]
    assert got == want


def test_dedup_keep_first_with_a_hot_key(spark):
    """One key holding most rows: the first copy in ingest order is kept and
    the copy count is exact (the aggregation merges the hot key map-side)."""
    from pyspark.sql import functions as F
    from uptake.operators.cleaning import _duplicates, dedup_keep_first

    hot = spark.range(20000).select(F.lit("k0").alias("event_id"), F.col("id").cast("string").alias("v"),
                                    (20000 - F.col("id")).alias("ingest_seq"))
    cold = spark.range(1, 51).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("event_id"),
                                     F.lit("x").alias("v"), F.lit(1).cast("long").alias("ingest_seq"))
    d = dedup_keep_first(hot.unionByName(cold).repartition(8), "event_id", copies_col="_copies")
    rows = {r.event_id: (r.v, r._copies) for r in d.collect()}
    assert len(rows) == 51
    assert rows["k0"] == ("19999", 20000)  # smallest ingest_seq (1) belongs to id 19999
    assert d.agg(_duplicates("event_id")).first()[0] == 19999


def test_minutes_keep_their_digits(spark):
    from decimal import Decimal
    from uptake.functions import half_up_decimal, safe_decimal
    texts = ["12.345", "0.004", "-1.5", " 7 ", "1e2", "abc", "NaN", "Infinity", None, "", "12.", "123456789012.123456"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in texts], "m string").select(safe_decimal("m")).collect()]
    want = ["12.345", "0.004", "-1.5", "7", "100", None, None, None, None, None, "12", "123456789012.123456"]
    assert got == [None if w is None else Decimal(w) for w in want]
    sums = spark.createDataFrame([(Decimal("29.999999"), 60), (Decimal("3.000000"), 60), (Decimal("2.999999"), 60), (Decimal("1"), 0)],
                                 "m decimal(28,6), d long")
    assert [r[0] for r in sums.select(half_up_decimal("m", "d", 1)).collect()] == [0.5, 0.1, 0.0, None]


def test_tabs_and_line_ends_are_stripped(spark):
    from uptake.functions.labels import blank_to_null, normalize_label, to_bool
    df = spark.createDataFrame([("\tTechnology\n", "true\t", "\t")], "l string, b string, e string")
    r = df.select(normalize_label("l", ["Technology"], {}).alias("l"), to_bool("b").alias("b"), blank_to_null("e").alias("e")).first()
    assert (r["l"], r["b"], r["e"]) == ("Technology", True, None)


def test_integer_division_is_exact(spark):
    from pyspark.sql import functions as F
    from uptake.functions.numeric import idiv
    cases = [(90071992547409930, 10), (2000000000000000007, 3), (9 * 10 ** 18, 7), (5, 0), (0, 4)]
    got = [r[0] for r in spark.createDataFrame(cases, "n long, d long").select(idiv(F.col("n"), F.col("d"))).collect()]
    assert got == [n // d if d else None for n, d in cases]


def test_csv_written_by_another_program_reads_back(spark, tmp_path):
    import csv
    from uptake.sources.csv_records import read_raw_csv
    rows = [['1', 'She said "hi", ok'], ['2', 'two\nlines, "quoted"'], ['3', 'plain']]
    with open(tmp_path / "x.csv", "w", newline="") as f:
        csv.writer(f).writerows([["id", "note"], *rows])
    got = read_raw_csv(spark, str(tmp_path / "x.csv")).select("id", "note").orderBy("id").collect()
    assert [list(r) for r in got] == rows
