"""Language identification by compression with one zstandard raw-content dictionary per language.

A text is encoded in blocks against each language's dictionary; the language whose dictionary gives the fewest bytes
wins. The score is the relative margin to the runner-up, and a text whose margin is narrow is rejected.

The dictionaries are learnt from a bounded sample of labelled rows (``SAMPLE_DOCS`` different texts per language, in hash order,
``EXCERPT`` characters from each), so model and broadcast are bounded by the number of languages.

Defined results: ``und`` with score 0, rejected, for a null text, a text without a letter, or when nothing could be
learnt; repeated rows are classified alike; ties go to the first language by code point; extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import pa_schema
from uptake.session import materialize

SAMPLE_DOCS = 300  #: labelled rows that a language is learnt from, at most
EXCERPT = 1200  #: characters of each that go into the dictionary
BLOCK = 4096  #: bytes of text that are encoded at a time
LEVEL = 3
MIN_MARGIN = 0.004  #: relative margin under which a text is rejected


def _first_hashes(named: DataFrame, k: int) -> DataFrame:
    """The ``k`` least different hashes ``h`` of each ``lang``, or all where there are fewer.

    Hashes are even, so those below ``4 k`` of a language's number are about ``4 k``: only these are ranked, and no task
    sees more of a language than that. Where they are fewer than ``k`` the bound is raised and they are counted again,
    at last without a bound.
    """
    sizes = named.groupBy("lang").agg(F.approx_count_distinct("h").alias("n"))
    share = 4.0 * k
    while True:
        bound = F.least(F.lit(1.0), F.lit(share) / F.col("n"))  # of the range of signed 64-bit numbers
        least = named.join(sizes, "lang").where((F.col("h").cast("double") / 2.0 ** 64 + 0.5 <= bound)).select("lang", "h").distinct()
        short = sizes.join(least.groupBy("lang").agg(F.count("*").alias("m")), "lang", "left").where(
            (F.coalesce("m", F.lit(0)) < k) & (bound < 1))
        if short.isEmpty():
            break
        share *= 8
    order = Window.partitionBy("lang").orderBy("h")
    return least.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionary bytes by language, from rows with a label and a text."""
    labelled = rows.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    named = labelled.select(F.col(lang).alias("lang"), F.xxhash64(text).alias("h"), F.substring(text, 1, EXCERPT).alias("t"))
    picked = _first_hashes(materialize(named.select("lang", "h").distinct(), "label-hashes"), SAMPLE_DOCS)
    texts = named.join(picked.select("lang", "h"), ["lang", "h"]).dropDuplicates(["lang", "h"])
    found: dict[str, list] = {}
    for r in texts.orderBy("lang", "h").collect():
        found.setdefault(r["lang"], []).append(r["t"])
    return {k: "\n".join(v).encode() for k, v in sorted(found.items())}


def classify(rows: DataFrame, model: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``rows`` with ``lang_pred``, ``score`` and ``rejected``."""
    names, held = [*model], rows.sparkSession.sparkContext.broadcast([*model.values()])
    rows = rows.drop("lang_pred", "score", "rejected")
    at = rows.columns.index(text)
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL("lang_pred string, score double, rejected boolean")
    out = StructType([*rows.schema.fields, *schema.fields])
    added = pa_schema("lang_pred string, score double, rejected boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard as zs
        packers = []
        for raw in held.value:
            d = zs.ZstdCompressionDict(raw, dict_type=zs.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            packers.append(zs.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

        def one(t: str | None) -> tuple[str, float, bool]:
            if not packers or t is None or not any(map(str.isalpha, t)):
                return "und", 0.0, True
            raw = t.encode()
            blocks = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
            sizes = [sum(len(p.compress(b)) for b in blocks) for p in packers]
            if len(sizes) == 1:
                return names[0], 1.0, False
            best, second = sorted(sizes)[:2]
            score = (second - best) / second
            return names[sizes.index(best)], score, score < min_margin

        for batch in batches:
            got = [one(t) for t in batch.column(at).to_pylist()]
            for i, f in enumerate(added):
                batch = batch.append_column(f.name, pa.array([g[i] for g in got], f.type))
            yield batch

    return rows.mapInArrow(run, out)


def held_out(key: str = "doc_id") -> Column:
    """Every third row by the CRC-32 of its key; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with the predictions of a model learnt from those of its labelled rows that are not held out."""
    train = docs.where(F.col("doc_id").isNotNull() & ~held_out())
    return classify(docs, learn(train))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is told with a clear margin, with their own columns whatever their names."""
    own = {c: f"{c}_of_the_row" for c in docs.columns if c in ("lang_pred", "score", "rejected")}
    found = identify(docs.withColumnsRenamed(own)).where("not rejected").drop("lang_pred", "score", "rejected")
    return found.withColumnsRenamed({v: k for k, v in own.items()}).select(docs.columns)
