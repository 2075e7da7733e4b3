"""Exact removal of word windows that occur more than once in the corpus, by factoring against an index.

A window is ``width`` words. Each text is parsed left to right into factors: runs of neighbouring windows that hang on
the same anchor, the word group with the smallest hash inside the window. Equal windows choose equal anchors, so equal
windows lie in factors of the same anchor. The index holds every factor of the corpus under its anchor:

* a factor that occurs twice or more is a duplicate span as a whole;
* where an anchor has several factors, one occurrence of each is cut at its boundaries into windows, and those that
  occur more than once are the duplicate spans.

Relative Lempel-Ziv against each reference block in turn would read every text once per block, which grows with the
square of the corpus; the index over all factors finds the same spans in a fixed number of passes.

Every position of every text is covered; texts are named by a hash of their content, so copies share one set of spans.
Word sequences are compared by two independent 64-bit hashes, which are differences of prefix sums over the words' own
hashes, so all factors or windows of a block of texts are hashed at once. Tables between the steps are deleted when the next one
is written.

Defined results: a null text has no words; texts under ``width`` words lose none; repeated rows are copies of each
other; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import discard, text_of
from uptake.session import materialize

BLOCK_TEXT = 1_000_000  #: bytes of the texts that are hashed together
GRAM = 17  #: words of an anchor; a window of 35 holds 19 of them
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  #: odd, so that powers can be divided away


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Words:
    """Hashes of the words of texts, and of any runs of them."""

    KEPT = 1 << 17  #: words whose hashes are kept

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.hashes = np.zeros((0, 2), np.uint64)
        self.powers = [np.ones(1, np.uint64) for _ in BASES]
        self.inverse = [np.ones(1, np.uint64) for _ in BASES]

    def _grow(self, n: int) -> None:
        have = len(self.powers[0])
        if have <= n:
            size = max(n + 1, 2 * have)
            for k, base in enumerate(BASES):
                for table, step in ((self.powers, base), (self.inverse, pow(base, -1, 1 << 64))):
                    row = np.full(size, step, np.uint64)
                    row[0] = 1
                    table[k] = np.multiply.accumulate(row)

    def of(self, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """The place of each text's first word in the row of all their words (and the end of the last), and for either
        base the prefix sums over that row that ``runs`` takes."""
        import xxhash
        if len(self.known) >= self.KEPT:
            self.known, self.hashes = {}, self.hashes[:0]
        split = [t.encode().split() for t in texts]  # bytes: ASCII white space only
        ends = np.cumsum([0, *map(len, split)])
        words = list(chain.from_iterable(split))
        new = list(set(words).difference(self.known))
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, new)), dtype=">u8").reshape(-1, 2)
            self.hashes = np.concatenate([self.hashes, digests.astype(np.uint64)])
        h = self.hashes[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]
        self._grow(len(words))
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(h[:, k] * self.powers[k][:len(words)], dtype=np.uint64)])
                for k in range(2)]
        return ends, sums

    def runs(self, sums: list[np.ndarray], start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        """Two hashes of each run of words ``start:end``; equal runs have equal ones wherever they stand."""
        return [_mix((s[end] - s[start]) * self.inverse[k][start] + (end - start).astype(np.uint64)).view(np.int64)
                for k, s in enumerate(sums)]

    def grams(self, sums: list[np.ndarray], gram: int) -> np.ndarray:
        """One hash of each run of ``gram`` words."""
        s, n = sums[0], len(sums[0]) - gram
        return _mix((s[gram:] - s[:n]) * self.inverse[0][:n])


def factors(g: np.ndarray, ends: np.ndarray, width: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Text, anchor, first window and number of windows of each factor, in order, over all windows of all texts.

    ``g`` are the hashes of the word groups of the row of all texts' words, windows count from the row's first word."""
    n = int(ends[-1]) - width + 1
    whole = np.maximum(np.diff(ends) - width + 1, 0)  # windows of each text
    if n < 1 or not whole.any():
        return (np.zeros(0, np.int64),) * 4
    # the first least hash of each window, by ranges of 1, 2, 4 ... groups and one last range that overlaps
    least, at, have, span = g, np.arange(len(g)), 1, width - gram + 1
    while have < span:
        step = min(have, span - have)
        right = least[step:] < least[:-step]
        least, at, have = np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step]), have + step
    first = np.repeat(ends[:-1] - np.cumsum(whole) + whole, whole) + np.arange(int(whole.sum()))
    text, at = np.repeat(np.arange(len(whole)), whole), at[first]
    cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])  # an anchor lies in one text
    return text[cut], g[at[cut]].view(np.int64), first[cut], np.diff(np.r_[cut, len(at)])


def blocks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """A batch in parts of some bytes of text each; a longer text is alone."""
    size = np.cumsum(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + BLOCK_TEXT, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _name(*cols):
    return F.struct(F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(1), *cols).alias("b"))


FACTORS = pa.schema([(c, pa.int64()) for c in ("na", "nb", "anchor", "fa", "fb")] + [("start", pa.int32()), ("size", pa.int32())])
WINDOWS = pa.schema([(c, pa.int64()) for c in ("wa", "wb", "fa", "fb")] + [("at", pa.int32()), ("n", pa.int64())])


def _batch(columns: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def repeated_spans(docs: DataFrame, width: int = 35, gram: int = GRAM) -> DataFrame:
    """Rows ``(na, nb, spans)`` per text with duplicates: ``spans`` holds ``(first window, mask)``, a bit per window."""
    texts = docs.select(_name(text_of("text")).alias("name"), text_of("text").alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for block in (part for batch in batches for part in blocks(batch, "text")):
            ends, sums = words.of(block.column("text").to_pylist())
            if ends[-1] < width:
                continue
            text, anchor, first, size = factors(words.grams(sums, gram), ends, width, gram)
            if len(text):
                fa, fb = words.runs(sums, first, first + size + width - 1)
                na, nb = (block.column(c).to_numpy(zero_copy_only=False)[text] for c in ("a", "b"))
                yield _batch([na, nb, anchor, fa, fb, first - ends[text], size], FACTORS)

    parsed = materialize(texts.select("name.a", "name.b", "text").mapInArrow(
        parse, "na long, nb long, anchor long, fa long, fb long, start int, size int"), "factors")
    # equal factors have equal anchors, so the anchor is no part of the key
    index = parsed.groupBy("fa", "fb").agg(F.count("*").alias("n"), F.min("anchor").alias("anchor"))
    index = materialize(index, "factor-index")
    several = index.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1").select("anchor")
    # one occurrence of each open factor is cut into windows; each text is read once for all its factors
    open_ = materialize(index.join(several, "anchor", "left_semi").select("fa", "fb", "n"), "open-factors")
    whole = materialize(index.where("n > 1").select("fa", "fb"), "whole-factors")
    discard(index)
    one = parsed.join(open_, ["fa", "fb"]).groupBy("fa", "fb").agg(
        F.min("n").alias("n"), F.min(F.struct("na", "nb", "start", "size")).alias("one"))
    wanted = one.select("fa", "fb", "n", "one.*").groupBy("na", "nb").agg(
        F.collect_list(F.struct("fa", "fb", "n", "start", "size")).alias("cuts"))
    # copies of a text need reading once: they are combined before the shuffle
    source = texts.select("name.*", "text").groupBy("a", "b").agg(F.max("text").alias("text"))
    source = source.join(wanted, (F.col("a") == F.col("na")) & (F.col("b") == F.col("nb"))).select("text", "cuts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for block in (part for batch in batches for part in blocks(batch, "text")):
            lists = block.column("cuts")
            cuts, text = lists.flatten(), np.repeat(np.arange(block.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            fa, fb, n, start, size = (cuts.field(i).to_numpy(zero_copy_only=False) for i in range(5))
            ends, sums = words.of(block.column("text").to_pylist())
            many = size.astype(np.int64)
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            first = np.repeat(ends[text] + start, many) + at
            yield _batch([*words.runs(sums, first, first + width), *(np.repeat(c, many) for c in (fa, fb)), at, np.repeat(n, many)], WINDOWS)

    windows = materialize(source.mapInArrow(cut, "wa long, wb long, fa long, fb long, at int, n long"), "windows")
    discard(open_)
    again = windows.groupBy("wa", "wb").agg(F.sum("n").alias("m")).where("m > 1").select("wa", "wb")
    masks = (windows.where("n = 1").join(again, ["wa", "wb"], "left_semi").groupBy("fa", "fb")
             .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("mask")))
    marks = materialize(whole.select("fa", "fb", F.lit(-1).cast("long").alias("mask")).union(masks), "marks")
    discard(windows)
    discard(whole)
    marked = parsed.drop("anchor").join(marks, ["fa", "fb"]).select(
        "na", "nb", F.struct("start", F.when(F.col("mask") == -1, F.expr("shiftleft(1L, size) - 1")).otherwise(F.col("mask")).alias("mask")).alias("span"))
    spans = materialize(marked.distinct().groupBy("na", "nb").agg(F.collect_list("span").alias("spans")), "spans")
    discard(parsed)
    discard(marks)
    return spans


def remove_repeats(docs: DataFrame, width: int = 35, gram: int = GRAM) -> DataFrame:
    """Per document: ``doc_id``, ``kept_text`` (kept words joined by one space), ``n_words`` and ``n_removed``."""
    spans = repeated_spans(docs, width, gram)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"), _name(text_of("text")).alias("name"))
    src = src.join(spans, (F.col("name.a") == F.col("na")) & (F.col("name.b") == F.col("nb")), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in (part for batch in batches for part in blocks(batch, "text")):
            split = [t.encode().split() for t in block.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, split)])
            lists = block.column("spans")
            spans, text = lists.flatten(), np.repeat(np.arange(len(split)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            start, mask = (spans.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            cover, left = np.zeros(ends[-1] + 1, dtype=np.int64), mask.astype(np.uint64)
            for bit in range(int(left.max(initial=0)).bit_length()):
                first = (ends[text] + start + bit)[(left >> np.uint64(bit) & np.uint64(1)) == 1]
                cover += np.bincount(first, minlength=len(cover)) - np.bincount(first + width, minlength=len(cover))
            gone = np.cumsum(cover)[:-1] > 0
            removed = np.diff(np.r_[0, np.cumsum(gone)][ends])
            kept = [b" ".join(compress(w, (~gone[lo:lo + len(w)]).tolist()) if r else w)
                    for w, lo, r in zip(split, ends.tolist(), removed.tolist())]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(np.diff(ends), pa.int64()),
                                              pa.array(removed, pa.int64())], names=["doc_id", "kept_text", "n_words", "n_removed"])

    return src.mapInArrow(run, "doc_id long, kept_text string, n_words long, n_removed long")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
