"""WARC archives: write one transaction per page, read archives back, and assemble captures.

Every page becomes a response or revisit record, a request record and a metadata record; the last two name the first
in ``WARC-Concurrent-To``, a revisit names the response's record in ``WARC-Refers-To``. Archives are gzip files in the
shared checkpoint folder, written by Spark's text writer: a record ends with CR LF CR LF, and the last LF is the
writer's line end, so a file is a plain sequence of records. Which page leads those of equal payload is decided on
narrow rows; the html is joined to that decision once, by its row.

Bounds: a file holds at most ``FILE_RECORDS`` pages of up to ``LARGE`` bytes, larger pages have a file each. Files are
unpacked as a stream and cut by Content-Length, record by record, never by searching for marks; Python steps hand a batch
on after ``BLOCK_BYTES``, so a task holds few records beside the one it works on. A response whose payload does not
match its digest ends the reading.

Assembly joins requests and metadata to their capture by record id and gives one nested row per capture.

Defined results: a null html is an empty payload, a null url an empty target; pages with the same id and payload are
all responses; a null page id is never a response that others refer to unless all ids of a payload are null, in which
case all are responses; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.llm.common import BLOCK_BYTES, pa_schema, text_of
from uptake.session import ensure_checkpoint_dir, materialize

FILE_RECORDS = 200  #: pages of one archive file, at most
LARGE = 1 << 20  #: bytes of a page above which it has a file of its own
#: fixed values of the format
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORD = ("record_id string, kind string, concurrent_to string, refers_to string, target_uri string, "
          "payload_digest string, block binary")


def _record(kind: str, rid: str, headers: list[tuple[str, str]], *block: bytes) -> list[bytes]:
    head = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", *(f"{k}: {v}" for k, v in headers),
            f"Content-Length: {sum(map(len, block))}"]
    return [("\r\n".join(head) + "\r\n\r\n").encode(), *block, b"\r\n\r\n"]


def _uri(seed: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, seed)}>"


def _line(text: str) -> str:
    """A header value: one line."""
    return " ".join(text.split("\r\n")).replace("\r", " ").replace("\n", " ")


def write_archives(pages: DataFrame, min_bytes: int = 0) -> str:
    """Write ``pages`` (``page_id``, ``url``, ``html``) and return the folder of the archives.

    Of pages with equal payloads of at least ``min_bytes`` bytes, that with the largest id is the response.
    """
    spark = pages.sparkSession
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col("page_id").cast("long").alias("page_id"),
                        text_of("url").alias("url"), text_of("html").cast("binary").alias("html")).withColumn("sha", F.unhex(F.sha1("html")))
    narrow = rows.select("row", "page_id", "sha", F.length("html").alias("size"))
    lead = narrow.groupBy("sha").agg(F.max("page_id").alias("lead"))
    tied = narrow.join(lead, "sha").withColumn("leads", F.col("page_id").eqNullSafe(F.col("lead")))
    first = tied.where("leads").groupBy("sha").agg(F.min("row").alias("lead_row"))
    refers = tied.join(first, "sha").select(
        "row", F.col("sha").alias("known_sha"),
        F.when(~F.col("leads") & (F.col("size") >= min_bytes), F.struct("lead", "lead_row")).alias("refers"))
    joined = rows.join(materialize(refers, "page-leads"), "row", "left").withColumn("sha", F.when(F.col("sha") == F.col("known_sha"), F.col(
        "sha")).otherwise(F.raise_error(F.lit("the pages changed while they were read")).cast("binary")))
    small = F.length("html") <= LARGE
    cols = joined.select("row", "page_id", "url", "html", "sha", "refers.lead", "refers.lead_row")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc/{uuid.uuid4().hex}"
    # the second pass reads lengths of all pages but writes only the large ones
    for name, part, records in (("small", cols.where(small), FILE_RECORDS), ("large", cols.where(~small), 1)):
        (part.mapInArrow(_transactions, "value string").write.option("compression", "gzip").option("lineSep", "\n")
         .option("maxRecordsPerFile", records).text(f"{path}/{name}"))
    return path


def _transactions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each page, as one value, in batches bounded by their bytes."""
    def flush():
        # UTF-8 by construction: headers are encoded and html was a string
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary()).cast(pa.string())], names=["value"])

    out, held = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row, page, url, html, sha, lead, lead_row = (c[i].as_py() for c in batch.columns)
            value = _transaction(row, page, url, html, sha, lead, lead_row)
            out.append(value)
            held += len(value)
            if held >= BLOCK_BYTES:
                yield flush()
                out, held = [], 0
    if out:
        yield flush()


def _rid(row: int, page: int | None, sha: bytes) -> str:
    return _uri(f"{row}/{page}/{sha.hex()}")


def _transaction(row, page, url: str, html: bytes, sha: bytes, lead, lead_row) -> bytes:
    rid, at = _rid(row, page, sha), _line(url)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    common = [("WARC-Target-URI", at), ("WARC-Date", DATE), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha).decode())]
    kind = ("Content-Type", "application/http; msgtype=response")
    if lead_row is None:
        main = _record("response", rid, [*common, kind], http, html)
    else:
        main = _record("revisit", rid, [*common, ("WARC-Refers-To", _rid(lead_row, lead, sha)), ("WARC-Profile", PROFILE), kind], http)
    linked = [("WARC-Concurrent-To", rid), ("WARC-Target-URI", at), ("WARC-Date", DATE)]
    ask = _record("request", _uri(f"{rid}/request"), [*linked, ("Content-Type", "application/http; msgtype=request")],
                  f"GET {at} HTTP/1.1\r\n\r\n".encode())
    fields = f"page_id: {'' if page is None else page}\r\npayload_bytes: {len(html)}\r\n"
    if lead_row is not None:
        fields += f"refers_to_page_id: {lead}\r\n"  # of the record in WARC-Refers-To, so that readers need not look it up
    about = _record("metadata", _uri(f"{rid}/metadata"), [*linked, ("Content-Type", "application/warc-fields")], fields.encode())
    return b"".join([*main, *ask, *about])[:-1]  # the writer's line end is the last byte


def parse(stream: io.BufferedIOBase) -> Iterator[tuple]:
    """Records of one unpacked archive, read one at a time and cut by Content-Length."""
    while version := stream.readline():
        if not version.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        head = {}
        while (line := stream.readline().decode().removesuffix("\r\n")):
            name, _, value = line.partition(":")
            head[name] = value.strip(" ")
        block = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {head['WARC-Record-ID']} is cut short")
        digest = head.get("WARC-Payload-Digest")
        if head["WARC-Type"] == "response" and digest is not None:
            payload = block[block.index(b"\r\n\r\n") + 4:]
            if digest != "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode():
                raise ValueError(f"the payload of {head['WARC-Record-ID']} does not match its digest")
        yield (head["WARC-Record-ID"], head["WARC-Type"], head.get("WARC-Concurrent-To"), head.get("WARC-Refers-To"),
               head.get("WARC-Target-URI"), digest, block)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives under ``path`` (plain or gzip files)."""
    out = pa_schema(RECORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_buffer()
                raw = pa.BufferReader(data)
                packed = data.size > 1 and data.slice(0, 2).to_pybytes() == b"\x1f\x8b"
                with (gzip.GzipFile(fileobj=raw) if packed else io.BufferedReader(io.BytesIO(data.to_pybytes()))) as stream:
                    for record in parse(stream):
                        rows.append(record)
                        held += len(record[-1])
                        if held >= BLOCK_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.where("length > 0").select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and metadata records."""
    def side(kind: str) -> DataFrame:
        # a capture has one of each; of several, the one with the smallest id counts
        return (records.where(F.col("kind") == kind).groupBy(F.col("concurrent_to").alias("record_id"))
                .agg(F.min(F.struct("record_id", "target_uri", F.col("block").cast("string").alias("block"))).alias(kind)))

    body = F.when(F.col("kind") == "response", F.expr(
        "substring(block, position(X'0D0A0D0A', block) + 4)")).alias("payload")
    main = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", "kind", "target_uri", "refers_to", "payload_digest", body)
    return main.join(side("request"), "record_id", "left").join(side("metadata"), "record_id", "left")


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back and assemble: one nested row per capture."""
    path = write_archives(pages, min_bytes)
    records = materialize(read_archives(pages.sparkSession, path), "records")
    return assemble(records)
