"""Every stage of the pipeline against a brute-force version, with columns that clash with the operators' own."""

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import ODD, SF, reach
from uptake.llm import langid, queries, secrets, simhash
from uptake.llm.packing import Encoder

CLASH = ("_h", "_n", "_before", "_q", "_rem", "s1", "s2", "s3", "z1", "z2", "src", "size", "taken", "target", "score", "rejected", "lang_pred",
         "row", "found", "repo", "owner", "spans", "fp", "node", "component", "own", "id", "class", "_words", "_text")
STAGE = dict(corpus_pipeline.STAGES)
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", params=["odd", "sf"])
def docs(request, spark):
    if request.param == "sf":
        return spark.read.parquet(f"{SF}/documents.parquet").withColumn("size", F.lit(7777))
    base = spark.createDataFrame([(*r, len(r[1] or "")) for r in [*ODD, (None, "null id text", "en", "a"), (None, "alone", "en", None), (17, "other text", "en", "a"), (17, "same id", "en", "b")]],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return base.select("*", *[F.lit(7777).alias(c) for c in CLASH])


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def frozen(rows, drop=()):
    return Counter(tuple(sorted((k, str(v)) for k, v in r.items() if k not in drop)) for r in rows)


def test_language_id_keeps_what_is_not_rejected(spark, docs):
    out = STAGE["language_id"](spark, docs, None)
    assert out.columns == docs.columns
    import zstandard as zs
    model = langid.learn(docs.where(F.col("doc_id").isNotNull() & ~langid.held_out()))
    packers = []
    for raw in model.values():
        d = zs.ZstdCompressionDict(raw, dict_type=zs.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=langid.LEVEL)
        packers.append(zs.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def clear(t):
        if not packers or t is None or not any(c.isalpha() for c in t):
            return False
        raw = t.encode()
        sizes = sorted(sum(len(p.compress(raw[i:i + langid.BLOCK])) for i in range(0, len(raw), langid.BLOCK)) for p in packers)
        return len(sizes) == 1 or (sizes[1] - sizes[0]) / sizes[1] >= langid.MIN_MARGIN
    assert frozen(rows_of(out)) == frozen([r for r in rows_of(docs) if clear(r["text"])])


def test_simhash_keeps_one_row_of_each_component(spark, docs):
    out = STAGE["simhash"](spark, docs, None)
    assert out.columns == docs.columns
    src = rows_of(docs)
    fps = [simhash.fingerprint(None if r["text"] is None else r["text"].encode()) for r in src]
    root = reach(len(src), [(i, j) for i in range(len(src)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    groups = defaultdict(list)
    for i, g in enumerate(root):
        groups[g].append(i)
    got = rows_of(out)
    assert len(got) == len(groups) and not frozen(got) - frozen(src)
    by_fp = defaultdict(list)
    for r in got:
        by_fp[root[next(i for i in range(len(src)) if fps[i] == simhash.fingerprint(None if r["text"] is None else r["text"].encode()))]].append(r["doc_id"])
    none = float("inf")
    assert by_fp == {g: [min((src[i]["doc_id"] for i in members), key=lambda d: none if d is None else d)] for g, members in groups.items()}


def test_secrets_are_masked_and_nothing_else_changes(spark, docs):
    out = rows_of(STAGE["secrets"](spark, docs, None))
    src = rows_of(docs)
    assert frozen(out, ("text", "n_chars")) == frozen(src, ("text", "n_chars"))
    plain = [r for r in src if not secrets.scan(r["text"] or "")]
    assert not frozen(plain) - frozen(out)
    for r in out:
        text = r["text"] or ""
        assert not re.search("AKIA[A-Z0-9]{14}", text) and not re.search("[0-9a-f]{16}", text)
        assert r["text"] is None or "n_chars" not in r or r["n_chars"] == len(r["text"])


def test_mixing_takes_copies_and_first_words(spark, docs):
    out = STAGE["mixing"](spark, docs, None)
    assert out.columns == docs.columns
    from uptake.llm import mixing
    taken = mixing.mix(docs)
    assert not set(mixing.ADDED) - set(taken.columns) and len(taken.columns) == len({*docs.columns, *mixing.ADDED})
    want = Counter()
    for r in rows_of(taken):
        words = WORDS.findall(r["text"] or "")
        if not words:
            want[r["doc_id"], r["text"]] += 1
            continue
        want[r["doc_id"], r["text"]] += r["taken"] // len(words)
        if r["taken"] % len(words):
            want[r["doc_id"], " ".join(words[:r["taken"] % len(words)])] += 1
    got = rows_of(out)
    assert Counter((r["doc_id"], r["text"]) for r in got) == +want
    assert {r["size"] for r in got} <= {7777}


def test_run_packs_what_the_stages_leave(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF)
        docs = spark.createDataFrame(left.collect(), left.schema)
    encode = Encoder(queries.word_tokenizer())
    want = Counter()
    for r in docs.collect():
        want[r["doc_id"]] += len(encode(r["text"] or "")) // 2 + 1
    got, places = Counter(), defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        got[r["doc_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for s, parts in places.items():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and (ends[-1] == 2048 or s == max(places))


def test_run_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
