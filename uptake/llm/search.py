"""Ranked lexical search, reversed: documents are streamed through an index of the items.

The items (queries) are cut into blocks of bounded size. For each block the terms of its items are indexed; the index
goes to every task, documents are turned into term counts once, and each document's counts are looked up there. A task
keeps one bounded heap an item; the heaps of all tasks are merged.

Scores are BM25 in whole numbers: ``w = floor(1000 ln((2N+2)/(2df+1)))``, ``m = 25 + 75 n N div L`` and a term adds
``w * (10**9 tf div (1000 tf + 8 m))``, once for each time it stands in the item.

A block's index is at most ``BLOCK_BYTES`` of item text, or one item; equal items are scored once. More items mean more
blocks, each of which reads the documents again.

Defined results: a null text has no terms, and a document or item without terms is in no result; ``N`` counts documents
with terms; rows with equal ids are documents, or items, of their own (a repeated item gives its rows once more); a
null doc_id comes after all others at equal scores; empty tables give no rows; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import pa_schema
from uptake.session import materialize

#: bytes of a term, once A-Z are lower-cased: digits, letters and all of non-ASCII characters
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes(range(256)).lower()

BLOCK_BYTES = 16 << 20  #: item text that one index holds
TEXTS = 256  #: texts that are counted in one go
CELLS = 1 << 18  #: scores (documents x items) that a task holds at once
LONG = 1 << 20  #: bytes above which a text's terms are not listed at once
EXACT = 2.0 ** 53  #: whole numbers below this are exact in doubles


def term_counts(text: bytes | None) -> Counter:
    """Terms of a text in UTF-8 and how often each occurs."""
    low = (text or b"").translate(LOWER)
    return Counter(TERM.findall(low) if len(low) < LONG else (m.group() for m in TERM.finditer(low)))


def _blocks(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """Different items with their number of copies, each in a block of at most ``BLOCK_BYTES`` (or a single item)."""
    items = items.select("item_id", F.col("text").cast("string").alias("text")).groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    size = F.octet_length("text")
    n = max(1, -(-(items.agg(F.sum(size)).first()[0] or 0) // BLOCK_BYTES))
    while True:
        placed = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)).cast("int"))
        sizes = placed.groupBy("block").agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("size"))
        if sizes.where((F.col("n") > 1) & (F.col("size") > BLOCK_BYTES)).isEmpty():
            return placed, [r["block"] for r in sizes.select("block").orderBy("block").toLocalIterator()]
        n *= 2


class Index:
    """Inverted index over the terms of a block's items: for term ``t``, items and counts at ``at[t]:at[t + 1]``."""

    def __init__(self, texts: list[str | None]):
        self.terms: dict[bytes, int] = {}
        post: list[list[tuple[int, int]]] = []
        self.items, self.longest = len(texts), 0
        for i, text in enumerate(texts):
            counts = term_counts(None if text is None else text.encode())
            self.longest = max(self.longest, sum(counts.values()))
            for term, n in counts.items():
                t = self.terms.setdefault(term, len(post))
                if t == len(post):
                    post.append([])
                post[t].append((i, n))
        self.at = np.cumsum([0, *map(len, post)])
        flat = np.array([p for ps in post for p in ps], dtype=np.int64).reshape(-1, 2)
        self.item, self.times = flat[:, 0], flat[:, 1]


def _counted(docs: DataFrame, index) -> DataFrame:
    """Per document with terms: ``(doc_id, n, terms, tfs)``, of the index's terms those that occur in it."""
    schema = "doc_id long, n long, terms array<int>, tfs array<int>"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.terms
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part, rows = batch.slice(at, TEXTS), []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts = term_counts(text)
                    if counts:
                        hits = [(known[t], c) for t, c in counts.items() if t in known]
                        rows.append((doc, counts.total(), [t for t, _ in hits], [c for _, c in hits]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, out)], schema=out)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary")).mapInArrow(run, schema)


def _scores(index: Index, weight: np.ndarray, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, docs: int) -> np.ndarray:
    """Scores (documents x items) of term occurrences ``(doc, term)`` that each add ``weight * gain``."""
    many = index.at[term + 1] - index.at[term]
    ends = np.cumsum(many)
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(index.at[term] - (ends - many), many)
    cell = np.repeat(doc, many) * index.items + index.item[place]
    value = np.repeat(weight[term] * gain, many) * index.times[place]
    if index.longest * float(weight.max(initial=0)) * 1e6 < EXACT:
        total = np.bincount(cell, value, docs * index.items).astype(np.int64)
    else:
        total = np.zeros(docs * index.items, np.int64)
        np.add.at(total, cell, value)
    return total.reshape(docs, index.items)


def _heaps(counted: DataFrame, index, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The ``k`` best documents of each item in each task: ``(item int, doc_id, score)``."""
    schema = "item int, doc_id long, score long"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx = index.value
        heaps = [[] for _ in range(idx.items)]
        least = np.zeros(idx.items, np.int64)  # a lower score enters no more
        step = max(1, CELLS // max(1, idx.items))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids, n = part.column(0).to_pylist(), part.column(1).to_numpy()
                m = 25 + 75 * n * n_docs // n_terms
                lens = np.diff(part.column(2).offsets.to_numpy())
                doc = np.repeat(np.arange(len(ids)), lens)
                term, tf = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy().astype(np.int64)
                gain = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])
                score = _scores(idx, weight, doc, term, gain, len(ids))
                for d in np.flatnonzero(((score > 0) & (score >= least)).any(axis=1)):
                    entry = (ids[d] is not None, -(ids[d] or 0))
                    for i in np.flatnonzero((score[d] > 0) & (score[d] >= least)):
                        heap = heaps[i]
                        if len(heap) < k:
                            heapq.heappush(heap, (int(score[d, i]), *entry))
                        else:
                            heapq.heappushpop(heap, (int(score[d, i]), *entry))
                        if len(heap) == k:
                            least[i] = heap[0][0]
        rows = [(i, -d if has else None, s) for i, heap in enumerate(heaps) for s, has, d in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, out)], schema=out)

    return counted.mapInArrow(run, schema)


def _search_block(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    block = items.select("item_id", "text", "copies").orderBy("item_id", "text").collect()  # at most BLOCK_BYTES, or one item
    index = Index([r["text"] for r in block])
    sent = spark.sparkContext.broadcast(index)
    counted = materialize(_counted(docs, sent), "term-counts")
    total = counted.agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_terms = total["N"], total["L"] or 1
    weight = np.zeros(len(index.terms), np.int64)
    df = counted.select(F.explode("terms").alias("t")).groupBy("t").count()  # at most one row for each term of the block
    for r in df.toLocalIterator():
        weight[r["t"]] = int(np.floor(1000 * np.log((2 * n_docs + 2) / (2 * r["count"] + 1))))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = materialize(_heaps(counted, sent, weight, n_docs, n_terms, k).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k), "block-top")
    sent.destroy()
    named = spark.createDataFrame([(i, r["item_id"], r["copies"]) for i, r in enumerate(block)],
                                  f"item int, item_id {items.schema['item_id'].dataType.simpleString()}, copies long")
    return top.join(named, "item").select("item_id", "rank", "doc_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """Rows ``(item_id, rank int, doc_id, score)``: the ``k`` best documents of each item, ties by ascending doc_id."""
    placed, blocks = _blocks(items)
    found = [_search_block(docs, placed.where(F.col("block") == b), k) for b in blocks]
    if not found:
        return items.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out
