"""The archive against hashlib and base64, and its records read by a plain parser."""

from __future__ import annotations

import base64
import hashlib
from pathlib import Path

import pytest
from pyspark.errors import PySparkException

from requestmill.llm import warc
from requestmill.llm.queries import op11_warc_archive

LONG = "<p>é</p>" * 40_000
PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2", "<p>one</p>"),
    (9, "http://a/9\r\nWARC-Type: evil", "<p>one</p>"),
    (9, "http://a/9", "<p>one</p>"),  # an id again
    (3, None, None),
    (4, "", ""),
    (None, "http://a/n", "<p>one</p>"),
    (None, "http://a/n", "only here\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (-5, "http://a/long?é", LONG),
    (6, "http://a/6", LONG),
    (7, "http://a/7", "a line\nand\r\n"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return rows.selectExpr("*", "1 AS `row`", "2 AS address", "'x' AS header", "3 AS n").repartition(3)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    """(page_id, bytes, digest, type, refers_to) of each row; of an id given twice one is the response."""
    payloads = {}
    for page_id, _, html in rows:
        payloads.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for data, ids in payloads.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        for k, page_id in enumerate(ids):
            first = k == len(ids) - 1 or len(data) < least
            out.append((page_id, len(data), digest(data), "response" if first else "revisit", None if first else ids[-1]))
    return out


def sort(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("least", [0, 1, 100])
def test_contents(spark, pages, folder, least):
    archive = warc.Archive(spark, folder).write(pages, least)
    assert sort(archive.contents().drop("url").collect()) == sort(expected(PAGES, least))
    assert archive.payloads().count() == len({p[2] or "" for p in PAGES})


def parsed(data: bytes):
    """(headers, block) of each record, by Content-Length alone."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        assert first == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        block = data[end + 4 : end + 4 + size]
        assert data[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
        yield fields, block
        at = end + 8 + size


def test_records_are_whole(spark, pages, folder):
    found = warc.Archive(spark, folder).write(pages).records().collect()
    assert len(found) == len(PAGES)
    assert sort((r["page_id"], r["payload"].decode()) for r in found) == sort((p, h or "") for p, _, h in PAGES)
    for r in found:
        ((fields, block),) = parsed(bytes(r["record"]))
        http, _, body = block.partition(b"\r\n\r\n")
        assert f"Content-Length: {len(r['payload'])}".encode() in http
        assert fields["WARC-Payload-Digest"] == "sha1:" + digest(bytes(r["payload"]))
        assert body == (b"" if fields["WARC-Type"] == "revisit" else r["payload"])
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")


def test_export(spark, pages, folder):
    archive = warc.Archive(spark, folder).write(pages)
    archive.export(f"{folder}/files")
    files = [f.read_bytes() for f in Path(folder, "files").glob("part-*")]
    found = [r for data in files for r in parsed(data)]
    assert len(found) == len(PAGES) and len({f["WARC-Record-ID"] for f, _ in found}) == len(PAGES)
    ids = {f["WARC-Record-ID"] for f, _ in found if f["WARC-Type"] == "response"}
    assert {f["WARC-Refers-To"] for f, _ in found if "WARC-Refers-To" in f} <= ids
    joined = sort((r["record"],) for r in archive.records().select("record").collect())
    assert sum(len(r[0]) for r in joined) == sum(map(len, files))


@pytest.mark.parametrize("fault", ["bytes", "lost"])
def test_spoilt_payloads_are_noticed(spark, pages, folder, fault):
    archive = warc.Archive(spark, folder).write(pages)
    stored = spark.read.parquet(f"{folder}/payloads")
    if fault == "bytes":
        bad = stored.selectExpr("address", "CASE WHEN octet_length(payload) = 12 THEN encode('other', 'utf-8') ELSE payload END AS payload")
    else:
        bad = stored.where("octet_length(payload) <> 12")
    other = warc.Archive(spark, f"{folder}/other")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{folder}/other/headers")
    bad.write.parquet(f"{folder}/other/payloads")
    with pytest.raises(PySparkException, match="payload"):
        other.contents().collect()
    with pytest.raises(PySparkException, match="payload"):
        other.records().collect()
    assert archive.contents().count() == len(PAGES)


def test_no_pages(spark, pages, folder):
    archive = warc.Archive(spark, folder).write(pages.where("false"))
    assert archive.contents().collect() == [] and archive.records().collect() == []


def test_hot_payload(spark, folder):
    """A third of all rows with one payload, another third without any."""
    rows = spark.range(6_000).selectExpr(
        "id AS page_id", "concat('u', id) AS url",
        "CASE id % 3 WHEN 0 THEN 'same' WHEN 1 THEN NULL ELSE concat('page ', id) END AS html",
    )
    found = warc.Archive(spark, folder).write(rows).contents()
    counts = {(r["record_type"], r["refers_to"]): r["count"] for r in found.groupBy("record_type", "refers_to").count().collect()}
    assert counts == {("response", None): 2_002, ("revisit", 5_997): 1_999, ("revisit", 5_998): 1_999}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sort(op11_warc_archive(spark, sf).collect()) == sort(expected(rows))
