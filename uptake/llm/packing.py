"""Pack tokenised documents into fixed-length sequences along a space-filling curve.

Each document becomes a hashed bag-of-tokens vector (log counts, unit length), is projected to a few dimensions by
fixed random signs, and gets the Hilbert index of its projected cell. Documents are range-sorted by that index, so
neighbours on the curve are alike, and are laid end to end in that order; sequences are cut out of the stream. Only
the last sequence of the corpus can need padding.

Defined results: a null or empty text is the end token alone; repeated rows are packed once each; an empty table gives
no pieces; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import discard, pa_schema, shuffle_parts, text_of
from uptake.session import materialize

BUCKETS = 256  #: dimensions of a hashed document vector
DIMS, BITS = 4, 10  #: projected dimensions, and bits of the curve's grid in each
TEXTS = 64  #: texts that are tokenised in one go

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of ``cells`` (unsigned grid coordinates below ``2 ** bits``)."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    # undo the rotations and reflections from the coarsest bit down, then Gray-decode across the axes
    for b in range(bits - 1, 0, -1):
        bit, low = 1 << b, (1 << b) - 1
        for i in range(dims):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[dims - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _signs() -> np.ndarray:
    return np.random.default_rng(1).choice([-1.0, 1.0], (BUCKETS, DIMS))


def _curve_key(ids: np.ndarray, signs: np.ndarray) -> np.ndarray:
    spread = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
    vec = np.log1p(np.bincount(spread.astype(np.int64), minlength=BUCKETS))
    return (vec / max(np.linalg.norm(vec), 1e-12)) @ signs


#: The pattern by which the tokenizer of the contract cuts texts into pieces, and the same for texts of
#: printable ASCII, accented Latin letters and white space, whose lower case and classes no Unicode version changes
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_TEXT = re.compile("[ -~\n\t\r\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e]*")
LATIN_PIECE = re.compile(
    "[a-z\u00df-\u00f6\u00f8-\u017e]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^a-z0-9 \n\t\r\u00df-\u00f6\u00f8-\u017e]+")


class Known:
    """Ids of words, in two generations of at most ``ENTRIES`` and one text's more: when the younger is full it becomes
    the older, whose words are taken over as they are met again and else forgotten. Long words are not kept."""

    ENTRIES, LONG = 1 << 17, 64

    def __init__(self, ids: Callable[[str], bytes]):
        self.ids, self.young, self.old = ids, {}, {}

    def of(self, words: list[str]) -> bytes:
        if len(self.young) >= self.ENTRIES:
            self.young, self.old = {}, self.young
        known, unkept = self.young, []
        for w in set(words).difference(known):
            got = self.old.get(w)
            known[w] = self.ids(w) if got is None else got
            if len(w) > self.LONG:
                unkept.append(w)
        out = b"".join([known[w] for w in words])
        for w in unkept:
            del known[w]
        return out


class Encoder:
    """Token ids of texts as little-endian bytes, equal to those of the tokenizer's ``encode``.

    Where the tokenizer drops white space and normalises character by character (see ``_by_words``), a text's ids are
    those of its words in a row, so a word is normalised, cut and merged by the tokenizer's own parts once and looked
    up from then on; texts of Latin letters are cut into the tokenizer's pieces at once. Other tokenizers encode each
    text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.type, self.code = ("<u2", "H") if self.tok.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.by_words, self.latin = _by_words(self.tok)
        self.words, self.pieces = Known(self._word), Known(self._piece)

    def _pack(self, ids: list[int]) -> bytes:
        out = array(self.code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _cut(self, normal: str) -> bytes:
        pieces = self.tok.pre_tokenizer.pre_tokenize_str(normal)
        return b"".join([self._pack([t.id for t in self.tok.model.tokenize(p)]) for p, _ in pieces])

    def _word(self, word: str) -> bytes:
        return self._cut(self.tok.normalizer.normalize_str(word))

    def _piece(self, piece: str) -> bytes:
        # bytes of printable ASCII stand for themselves in the model
        return self._pack([t.id for t in self.tok.model.tokenize(piece)]) if piece.isascii() else self._cut(piece)

    def __call__(self, text: str) -> bytes:
        if not self.by_words:
            return self._pack(self.tok.encode(text, add_special_tokens=False).ids)
        if self.latin and LATIN_TEXT.fullmatch(text):
            return self.pieces.of(LATIN_PIECE.findall(text.lower()))
        return self.words.of(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))


def _by_words(tok) -> tuple[bool, bool]:
    """Whether ids of a text are the ids of its words in a row: no added tokens but special ones (which are ordinary text
    here), a normalizer of steps that do not look across white space, a pre-tokenizer that drops it. And whether the
    pre-tokenizer is that of ``PIECE`` over bytes, after lower-casing."""
    spec = json.loads(tok.to_str())
    norm = spec["normalizer"] or {}
    steps = norm.get("normalizers", [norm] if norm else [])
    plain = all(n["type"] in ("NFC", "Lowercase") or (n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " ")
                for n in steps)
    if not steps or not plain or spec["pre_tokenizer"] is None or not all(t["special"] for t in spec["added_tokens"]):
        return False, False
    cut = spec["pre_tokenizer"].get("pretokenizers", [])
    latin = [n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cut] == ["Split", "ByteLevel"] and (
        cut[0]["pattern"], cut[0]["behavior"], cut[0]["invert"]) == ({"Regex": PIECE}, "Removed", True) and not (
        cut[1]["add_prefix_space"] or cut[1]["use_regex"])
    return [p for p, _ in tok.pre_tokenizer.pre_tokenize_str(" a  b\tc\n")] == ["a", "b", "c"], latin


def tokens(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Rows ``(doc_id, ids binary, n long, curve long)``: little-endian unsigned ids, the end id included."""
    schema = "doc_id long, ids binary, n long, curve long"
    out = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = Encoder(tokenizer)
        end = np.array([end_id], dtype=encode.type).tobytes()
        signs = _signs()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                block = batch.slice(at, TEXTS)
                raw = [encode(t) + end for t in block.column(1).to_pylist()]
                ids = [np.frombuffer(r, dtype=encode.type) for r in raw]
                flat = np.stack([_curve_key(i, signs) for i in ids])
                cells = np.clip((flat + 1.5) / 3 * (1 << BITS), 0, (1 << BITS) - 1)
                yield pa.RecordBatch.from_arrays([
                    block.column(0).cast(pa.int64()), pa.array(raw, pa.binary()), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array(hilbert_index(cells, BITS), pa.int64())], schema=out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")).mapInArrow(run, schema)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row of a sorted partition the number of tokens before it there."""
    at = 0
    for batch in batches:
        n = batch.column("n").to_numpy()
        upto = at + np.cumsum(n)
        yield batch.append_column("at", pa.array(upto - n, pa.int64()))
        at = int(upto[-1]) if len(n) else at


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: its document, place there, length and CRC-32, its sequence and offset there."""
    spark = docs.sparkSession
    toks = materialize(tokens(docs, tokenizer, end_id), "tokens")
    laid = (toks.repartitionByRange(shuffle_parts(spark), "curve", "doc_id", F.crc32("ids"))
            .sortWithinPartitions("curve", "doc_id", F.crc32("ids"))
            .select("doc_id", "ids", "n", F.spark_partition_id().alias("part"))
            .mapInArrow(_running, "doc_id long, ids binary, n long, part int, at long"))
    laid = materialize(laid, "laid")
    discard(toks)
    # one row for each partition of the sort
    before, base = 0, {}
    for r in laid.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").toLocalIterator():
        base[r["part"]] = before
        before += r["n"]
    out = pa_schema(PIECES)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, raw, n, part, at in zip(*(batch.column(c).to_pylist() for c in range(5))):
                ids = np.frombuffer(raw, dtype=f"<u{len(raw) // n}").astype("<u4").tobytes()
                start, place = 0, base[part] + at
                while start < n:
                    seq, offset = divmod(place + start, length)
                    size = min(n - start, length - offset)
                    rows.append((doc, start, size, zlib.crc32(ids[4 * start:4 * (start + size)]), n, seq, offset))
                    start += size
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 7)], schema=out)

    return laid.mapInArrow(cut, PIECES)
