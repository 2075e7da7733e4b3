"""WARC: large pages, resolvable references, payloads that do not match their digest."""

import gzip
import io

import pytest
from pyspark.sql import functions as F

from uptake.llm import warc


def test_a_large_page_and_many_small_ones(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 200_000)
    rows = [(i, f"http://x/{i}", f"page {i % 70}" * 900) for i in range(900)]
    pages = spark.createDataFrame([*rows, (5000, None, "é" * 25_000_000), (5001, "u", "z" * 1_200_000), (5002, "v", "z" * 1_200_000)],
                                  "page_id long, url string, html string")
    got = warc.captures(pages)
    by_kind = {r["kind"]: r["count"] for r in got.groupBy("kind").count().collect()}
    assert by_kind == {"response": 72, "revisit": 831}
    size = got.where("kind = 'response'").select(F.max(F.length("payload"))).first()[0]
    assert size == 50_000_000


def test_revisits_name_the_record_of_their_response(spark):
    pages = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (2, "c", "x"), (3, "d", "y"), (None, "e", "y"), (None, "f", "z")],
                                  "page_id long, url string, html string")
    got = warc.captures(pages).select("record_id", "kind", "refers_to").collect()
    answers = {r["record_id"] for r in got if r["kind"] == "response"}
    assert len(answers) == 4
    assert [r["refers_to"] in answers for r in got if r["kind"] == "revisit"] == [True, True]


def test_wrong_payloads_and_cut_records_are_refused():
    record = b"".join(warc._record("response", "<urn:x>", [("WARC-Payload-Digest", "sha1:AAAA")], b"HTTP/1.1 200 OK\r\n\r\n", b"body"))
    with pytest.raises(ValueError, match="does not match"):
        list(warc.parse(io.BytesIO(record)))
    plain = b"".join(warc._record("metadata", "<urn:y>", [("Empty", "")], b"a: b"))
    assert [r[:2] + (r[-1],) for r in warc.parse(io.BytesIO(plain * 2))] == [("<urn:y>", "metadata", b"a: b")] * 2
    for broken in (plain[:-1], plain + b"x\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(broken)))


def test_plain_and_packed_files_read_alike(spark, tmp_path):
    plain = b"".join(warc._record("metadata", "<urn:y>", [], b"a: b"))
    (tmp_path / "a.warc").write_bytes(plain)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(plain) + gzip.compress(plain))
    (tmp_path / "c.warc").write_bytes(b"")
    assert [bytes(r["block"]) for r in warc.read_archives(spark, str(tmp_path)).collect()] == [b"a: b"] * 3
