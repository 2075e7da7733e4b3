"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame`` over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.llm import (
    conversations, embeddings, exact, langid, mixing, packing, quality, search, secrets, sharding, simhash, substrings, warc,
)
from uptake.llm.common import table, text_of
from uptake.llm.sql import SQL

SHARDS = 40


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, along the Hilbert curve."""
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer(), 2048, 1)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by a uniform shuffle; law ``rows``."""
    text = text_of("text")
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return sharding.uniform_shards(rows, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at cosine 0.95."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components at 2 differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, with the ownership verdict over the corpus."""
    return secrets.report(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures of all documents and the verdict of the weighed rules."""
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without repeated windows of 35 words."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), 35).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of all pages, written to archives and read back."""
    got = warc.captures(table(spark, sf_dir, "pages"))
    field = lambda name: F.nullif(F.regexp_extract("metadata.block", rf"(?m)^{name}: (-?\d+)", 1), F.lit("")).cast("long")
    return got.select(
        field("page_id").alias("page_id"), field("payload_bytes").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"), F.col("kind").alias("record_type"),
        field("refers_to_page_id").alias("refers_to"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that are equal without white space, and the row that stays of each."""
    return exact.duplicates(table(spark, sf_dir, "documents"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of all conversations, after the damage that the contract states."""
    rows = conversations.damage(table(spark, sf_dir, "conversations"))
    report, pieces = conversations.repair(rows, F.col("gone"))
    sha = conversations.digests(pieces).withColumnRenamed("conv_id", "c")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    return report.join(sha, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        *report.columns, F.coalesce("sha", empty).alias("repaired_sha256"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10).select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: name -> (query, DuckDB SQL, or None where SQL cannot express it and tests hold it against brute force)
LLM_REGISTRY = {f.__name__: (f, SQL.get(f.__name__)) for f in (
    op1_packing, op2_sharding, op3_language, op4_embedding_dedup, op5_simhash, op6_secrets, op7_mixing, op8_quality,
    op9_substrings, op10_warc, op11_exact_dedup, op12_conversations, op13_search)}
