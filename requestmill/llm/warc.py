"""Content-addressed WARC archive.

Payload bytes are stored once, in a table whose key is their SHA-256; the exact header of each
record is kept in another table and names the address of its payload. A join of both gives the
records back as they were, and reading hashes the stored bytes again. An archive is two Parquet
tables in a folder that all executors share; ``export`` writes plain WARC files from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from requestmill.llm.common import let

END = "\r\n"
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Digits of numbers to base 32, and what the WARC format writes for them.
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def sha1_base32(data: Column) -> Column:
    """32 characters: ten hexadecimal digits are eight of base 32."""

    def encoded(digits: Column) -> Column:
        groups = (
            F.lpad(F.conv(F.substring(digits, k, 10), 16, 32), 8, "0") for k in range(1, 41, 10)
        )
        return F.translate(F.concat(*groups), *BASE32)

    return let(F.sha1(data), encoded)


def _payload(html: Column) -> Column:
    return F.coalesce(html.cast("string"), F.lit("")).cast("binary")


def _address(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def _line(name: str, value: Column) -> Column:
    """A header line; empty where there is no value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def _record_id(page_id: Column, row: Column) -> Column:
    page = F.coalesce(page_id.cast("string"), F.lit("-"))
    return F.concat(F.lit("<urn:page:"), page, F.lit(":"), row.cast("string"), F.lit(">"))


def _one_line(url: Column) -> Column:
    """A line break or a zero byte in an address would end or spoil its header line."""
    for sign, code in (("\r", "%0D"), ("\n", "%0A"), ("\0", "%00")):
        url = F.replace(url, F.lit(sign), F.lit(code))
    return url


def _header(date: str) -> Column:
    """Everything of a record before its payload: WARC header, then HTTP header."""
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("n").cast("string"),
        F.lit(END * 2),
    )
    kind = F.when(F.col("first_row").isNull(), "response").otherwise("revisit")
    content = F.octet_length(http) + F.when(F.col("first_row").isNull(), F.col("n")).otherwise(0)
    first = F.when(
        F.col("first_row").isNotNull(), _record_id(F.col("first_page"), F.col("first_row"))
    )
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("row"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _one_line(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", first),
        _line("WARC-Profile", F.when(F.col("first_row").isNotNull(), F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", content.cast("string")),
        F.lit(END),
        http,
    )


def _field(name: str, pattern: str = "[^\r\n]*") -> Column:
    """The value of a header line, null where the line is missing."""
    said = F.regexp_extract("header", f"\r\n{name}: ({pattern})\r\n", 1)
    return F.when(F.contains("header", F.lit(f"{END}{name}: ")), said)


def _page_of(record_id: Column) -> Column:
    page = F.regexp_extract(record_id, "^<urn:page:(-|-?[0-9]+):[0-9]+>$", 1)
    return F.when(page != "-", page).cast("long")


def _or_fail(value: Column, holds: Column, fault: str) -> Column:
    return F.when(holds, value).otherwise(F.raise_error(F.lit(fault)).cast("long"))


class Archive:
    """Two tables in ``folder``: ``headers`` (row, address, header) and ``payloads`` (address, payload)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def write(self, pages: DataFrame, least_bytes: int = 0, date: str = DATE) -> Archive:
        """A record for each row of ``pages`` (page_id, url, html); other columns are not read.

        Null html is an empty payload. Of the records with one payload of ``least_bytes`` or more,
        the one with the largest page_id (a null one is smallest; of rows that repeat it, the one
        read last) is the response and the others revisit it; records of smaller payloads are all
        responses. A null url has no line. No pages give two tables without rows. If two payloads
        that differ in length or SHA-1 have one SHA-256, writing fails.

        Payloads are hashed in place. One copy of each is shuffled for each reading task at most, so a
        payload that a third of all pages have costs no more than others.
        """
        rows = pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("page_id").cast("long").alias("page_id"),
            F.col("url").cast("string").alias("url"),
            _payload(F.col("html")).alias("payload"),
        ).select(
            "row",
            "page_id",
            "url",
            _address("payload").alias("address"),
            sha1_base32(F.col("payload")).alias("digest"),
            F.octet_length("payload").cast("long").alias("n"),
        )
        rows.write.parquet(f"{self.folder}/rows")
        rows = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/rows")
        same = (F.min("digest") == F.max("digest")) & (F.min("n") == F.max("n"))
        last = F.max(F.struct("page_id", "row"))
        firsts = (
            rows.groupBy("address")
            .agg(last.alias("last"), same.alias("same"))
            .select(
                "address",
                F.col("last.page_id").alias("first_page"),
                _or_fail(F.col("last.row"), F.col("same"), "two payloads have one address").alias("first_row"),
            )
        )
        refers = (F.col("n") >= least_bytes) & (F.col("row") != F.col("first_row"))
        headers = (
            rows.join(firsts, "address")
            .withColumn("first_row", F.when(refers, F.col("first_row")))
            .select("row", "address", _header(date).alias("header"))
        )
        headers.write.parquet(f"{self.folder}/headers")
        payloads = pages.select(_payload(F.col("html")).alias("payload"))
        payloads.select(_address("payload").alias("address"), "payload").dropDuplicates(
            ["address"]
        ).write.parquet(f"{self.folder}/payloads")
        return self

    def headers(self) -> DataFrame:
        """(row, address, header, page_id, url, digest, record_type, refers_to), read from the headers."""
        return self._table("headers").select(
            "row",
            "address",
            "header",
            _page_of(_field("WARC-Record-ID")).alias("page_id"),
            _field("WARC-Target-URI").alias("url"),
            F.replace(_field("WARC-Payload-Digest"), F.lit("sha1:"), F.lit("")).alias("digest"),
            _field("WARC-Type").alias("record_type"),
            _page_of(_field("WARC-Refers-To")).alias("refers_to"),
        )

    def payloads(self) -> DataFrame:
        """(address, payload, payload_bytes, payload_digest), each hashed again; fails on spoilt bytes."""
        stored = self._table("payloads")
        sound = F.col("address") == _address("payload")
        return stored.select(
            "address",
            "payload",
            _or_fail(
                F.octet_length("payload").cast("long"), sound, "a stored payload is not what its address says"
            ).alias("payload_bytes"),
            sha1_base32(F.col("payload")).alias("payload_digest"),
        )

    def _joined(self, *columns: str) -> DataFrame:
        stored = self.payloads().select("address", "payload_bytes", "payload_digest", *columns)
        # an outer join: a record whose payload is lost must fail, not vanish
        found = self.headers().join(stored, "address", "left")
        sound = F.coalesce(F.col("digest") == F.col("payload_digest"), F.lit(False))
        return found.withColumn(
            "payload_bytes", _or_fail(F.col("payload_bytes"), sound, "a header's payload is missing or another")
        )

    def contents(self) -> DataFrame:
        """(page_id, url, payload_bytes, payload_digest, record_type, refers_to), a row for each record.

        Payload bytes are hashed where they are stored; only the results are joined to the headers.
        """
        return self._joined().select(
            "page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"
        )

    def records(self) -> DataFrame:
        """(page_id, record, payload): records byte for byte, and the payload of revisits as well."""
        end = F.lit(END * 2).cast("binary")
        body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
        return self._joined("payload").where("payload_bytes IS NOT NULL").select(
            "page_id", F.concat(F.col("header").cast("binary"), body, end).alias("record"), "payload"
        )

    def export(self, folder: str, compression: str = "none") -> None:
        """Plain WARC files, one for each task. A record's own last line feed ends its line."""
        whole = F.col("record").cast("string")
        lines = self.records().select(F.substring(whole, F.lit(1), F.char_length(whole) - 1))
        lines.write.option("lineSep", "\n").option("compression", compression).text(folder)
