"""Exact duplicates, conversation repair and ranked search: odd rows against their SQL, and brute force on small cases."""

import itertools
import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare
from uptake.llm import conversations, exact, queries, search

NEW = ("op11_exact_dedup", "op12_conversations", "op13_search")
LONG = " ".join(f"w{i % 977}" for i in range(200_000))
DOCS = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG + " "), (6, "the same  text"), (6, "the same  text"), (7, "thesametext"),
    (8, "the  same\ntext "), (None, "the same  text"), (None, "no id"), (None, "no id"), (9, "Ünï çode ТЕСТ 12_3 \x00\x1f x"), (10, "ÜNÏ çode тест 12"),
    (11, "a b"), (12, "ab"), (13, "\U0001F600 smile \U0001F600"), (14, "x" * 33), (15, "x" * 32 + "y"), (16, "?? !!"),
]
ITEMS = [(1, "the same text"), (2, None), (3, ""), (4, "??"), (5, "Çode çode ünï 12 тест"), (5, "Çode çode ünï 12 тест"), (None, "text w5 w6"),
         (6, "nothing of this"), (7, LONG), (8, "\U0001F600 the the the")]
TURNS = ["Fine.", "Well", "Is it? ", "Yes!\n", "", " ", "no end", None]


def talk_rows():
    rng = random.Random(4)
    rows = [(None, 0, "user", "Who?"), (None, 1, "assistant", "Me."), (None, None, None, None), (-1, None, "", "Empty role."),
            (-1, None, "", "Empty role."), (-2, 5, "tool", "Odd role."), (-3, 1, "user", LONG + "."), (-3, 2, "assistant", LONG)]
    for conv in range(300):
        for _ in range(rng.choice([1, 2, 3, 6, 9])):
            rows.append((conv, rng.choice([None, *range(8)]), rng.choice(["system", "user", "assistant", "user", "assistant", "", None, "tool"]),
                         rng.choice([*TURNS, f"Turn {rng.random()}.", f"Cut {rng.random()}"])))
    for conv, n in ((1000, 60), (1001, 41)):  # cut into pieces by the tests
        rows += [(conv, t, rng.choice(["user", "assistant", "system", "user", "assistant"]), rng.choice(["Yes.", f"Line {t}.", f"Cut {t}"])) for t in range(n)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    extra = [F.lit(1).alias(c) for c in ("norm", "sha", "part", "run", "ends", "edge", "payload", "n", "terms", "score", "rank", "copies", "block", "item")]
    spark.createDataFrame(DOCS, "doc_id long, text string").select("*", *extra).coalesce(1).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").select("*", *[c for c in extra]).coalesce(1).write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(talk_rows(), "conv_id long, turn long, role string, text string").select(
        "*", *[F.lit(True).alias(c) for c in ("gone", "pos", "piece", "pieces", "kind", "copy", "opens")]).coalesce(1).write.parquet(f"{d}/conversations.parquet")
    return d


def duck(d):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet/*.parquet'")
    return con


@pytest.mark.parametrize("name", NEW)
def test_odd_rows_equal_sql(spark, odd, name):
    fn, sql = queries.LLM_REGISTRY[name]
    ok, message = compare(fn(spark, odd), duck(odd), sql)
    assert ok, message


@pytest.mark.parametrize("name", NEW)
def test_empty_tables(spark, odd, tmp_path, name):
    for t in ("documents", "benchmark", "conversations"):
        spark.read.parquet(f"{odd}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert queries.LLM_REGISTRY[name][0](spark, str(tmp_path)).collect() == []


def test_search_of_no_documents_or_no_items(spark, odd):
    docs, items = (spark.read.parquet(f"{odd}/{t}.parquet") for t in ("documents", "benchmark"))
    assert search.rank(docs.where("false"), items).collect() == []
    assert search.rank(docs, items.where("false")).collect() == []


@pytest.mark.parametrize("rows,size", [(2, 1 << 30), (7, 1 << 30), (2000, 50)])
def test_conversations_in_pieces_equal_sql(spark, odd, monkeypatch, rows, size):
    monkeypatch.setattr(conversations, "ROWS", rows)
    monkeypatch.setattr(conversations, "BYTES", size)
    fn, sql = queries.LLM_REGISTRY["op12_conversations"]
    ok, message = compare(fn(spark, odd), duck(odd), sql)
    assert ok, message


def brute(rows):
    """The least (cost, letters) over all edits with up to three insertions."""
    best = None
    options = [["D"] if gone else ["D", "K", "R"] for _, gone, _ in rows]
    for choice in itertools.product(*options):
        for places in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(len(rows) + 1), n) for n in range(4)):
            letters = "".join("I" * places.count(i) + (choice[i] if i < len(rows) else "") for i in range(len(rows) + 1))
            cost = sum({"D": 2, "I": 5, "K": 0, "R": 1}[c] for c in letters)
            cost += sum(extra for c, (_, _, extra) in zip(choice, rows) if c != "D")
            if (best is None or (cost, letters) < best) and legal(rows, letters):
                best = cost, letters
    return best


def legal(rows, word):
    state, at = 0, 0
    for c in word:
        if c == "I":
            state = conversations.GIVEN[state]
            continue
        initial = rows[at][0]
        at += 1
        if c == "R":
            state = conversations.GIVEN[state]
        if c == "K":
            if initial not in conversations.STEP[state]:
                return False
            state = conversations.STEP[state][initial]
    return state in conversations.ENDS


def test_search_is_least_of_all_edits():
    rng = random.Random(1)
    for _ in range(400):
        rows = [(rng.choice("suat"), gone := rng.random() < 0.2, 0 if gone else rng.choice([0, 0, 5])) for _ in range(rng.randrange(6))]
        assert conversations.search(rows) == brute(rows)


def test_search_of_a_long_conversation_is_linear():
    rng = random.Random(2)
    rows = [(rng.choice("suaua"), False, rng.choice([0, 0, 0, 5])) for _ in range(20_000)]
    cost, letters = conversations.search(rows)
    assert legal(rows, letters) and len(letters) >= 20_000 and cost > 0


def test_pieces_hold_the_repaired_rows(spark, odd):
    rows = conversations.damage(spark.read.parquet(f"{odd}/conversations.parquet"))
    _, pieces = conversations.repair(rows, F.col("gone"))
    for r in pieces.where("conv_id >= 0").collect():
        assert len(r["roles"]) == len(r["texts"])
        if r["pieces"] == 1:
            first = "".join(x[:1] for x in r["roles"])
            assert first == "" or first.lstrip("s") == "ua" * (len(first.lstrip("s")) // 2)


def test_hot_group_is_cut_over_partitions_and_counted_whole(spark):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20_000, F.lit("a hot text "))
                                      .otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    placed = exact._sorted_runs(rows, None)
    parts = {r["part"]: r["n"] for r in placed.where(F.col("sha") == F.unhex(F.sha2(F.lit("ahottext").cast("binary"), 256))).groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert len(parts) > 2 and max(parts.values()) < 10_000
    got = exact.duplicates(rows)
    assert got.where("kept").count() == 10_001
    assert {tuple(r) for r in got.where("doc_id < 20000").select("keep_id", "group_size").distinct().collect()} == {(0, 20_000)}


def test_deduplicate_keeps_all_columns(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    got = exact.deduplicate(docs)
    assert got.columns == docs.columns
    assert got.count() == exact.duplicates(docs).where("kept").count()
    # the space of document 11 is none of the deleted ones
    assert Counter(r["doc_id"] for r in got.collect()) == Counter([None, 3, 5, 8, 9, 10, 11, 12, 13, 14, 15, 16])


def test_search_in_blocks_equals_one_block(spark, odd, monkeypatch):
    docs, items = (spark.read.parquet(f"{odd}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = sorted(map(str, search.rank(docs, items).collect()))
    monkeypatch.setattr(search, "BLOCK_BYTES", 60)
    monkeypatch.setattr(search, "CELLS", 3)
    monkeypatch.setattr(search, "EXACT", 0.0)
    monkeypatch.setattr(search, "LONG", 8)
    assert sorted(map(str, search.rank(docs, items).collect())) == whole
