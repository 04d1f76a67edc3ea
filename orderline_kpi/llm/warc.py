"""WARC archives: writing captures and assembling them again by transaction.

A capture is three records: the request, the response (or, for a payload that another page has as
well, a revisit), and metadata.  Request and metadata name the response in
``WARC-Concurrent-To``.  Archives are written by Spark's text writer: every row is one record, and the line
separator is the empty lines that end a record, so the bytes are exactly a WARC file's.  Reading
parses each archive by the records' own lengths, computes digests of what is really there, and
joins the records of a capture through their identifiers.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderline_kpi.llm.common import filled

CRLF = "\r\n"
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "record_id string, type string, concurrent_to string, refers_to string, target string, date string, "
    "page_id long, http_head string, payload binary, payload_bytes long, payload_digest string"
)
_ROWS_OUT, _PIECE = 64, 1 << 16
_SEPARATOR = (CRLF * 2).encode()


def _base32_of_hex(digest: Column) -> Column:
    """Base32 of 40 hex digits: four digits of it for every five."""
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(name + ": "), value, F.lit(CRLF))


def _record(kind: Column, record_id: Column, headers: list[Column], block: Column) -> Column:
    return F.concat(
        F.lit(VERSION + CRLF), _header("WARC-Type", kind), _header("WARC-Record-ID", record_id), *headers,
        _header("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block,
    )


def _clean(value: Column) -> Column:
    """Without what would end a header line."""
    return F.regexp_replace(value, r"[\r\n\x00]+", " ")


def _urn(kind: str, key: Column) -> Column:
    """A record identifier made from the capture's key, the same in every run."""
    digest = F.md5(F.concat(F.lit(kind + ":"), key).cast("binary"))
    part = lambda a, n: F.substring(digest, a, n)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), F.lit(">"))


def write_archives(
    pages: DataFrame, path: str, min_revisit_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html", date: str = "2024-01-01T00:00:00Z", records_per_file: int = 30_000,
) -> None:
    """Write request, response or revisit, and metadata of each page as gzipped WARC files below ``path``.

    The payload is the page's html in UTF-8; null counts as empty.  Of pages with one payload of at least
    ``min_revisit_bytes`` bytes that with the largest id is the response and the others revisit
    it, without the payload; null ids come before all others.  Of rows with that id and payload the one with the largest url is
    referred to.  Rows that agree in id, payload and url have records with the same identifiers.  A null url is an empty one.
    """
    html, url = filled(F.col(html_column)), _clean(filled(F.col(url_column)))
    page = F.col(id_column).cast("long")
    rows = pages.select(
        page.alias("page"), url.alias("url"), html.alias("html"), F.octet_length(html).alias("size"),
        F.sha1(html.cast("binary")).alias("digest"),
    )
    # One row per payload and task moves; the pages themselves join with it by digest.
    last = rows.groupBy("digest", "size").agg(F.max(F.struct("page", "url")).alias("last")).select(
        "digest", "size", F.col("last.page").alias("last"), F.col("last.url").alias("last_url"))
    rows = rows.join(last, ["digest", "size"]).withColumns({
        "revisit": (F.col("size") >= min_revisit_bytes) & ~F.col("page").eqNullSafe(F.col("last")),
        "digest": F.concat(F.lit("sha1:"), _base32_of_hex(F.col("digest"))),
        
    })
    key = lambda page, url: F.concat_ws(" ", F.coalesce(page.cast("string"), F.lit("-")), "digest", url)
    rows = rows.withColumns({"key": key(F.col("page"), F.col("url")), "last_key": key(F.col("last"), F.col("last_url"))})
    capture, moment = _urn("response", F.col("key")), _header("WARC-Date", F.lit(date))
    target = F.when(F.col("url") != "", _header("WARC-Target-URI", F.col("url"))).otherwise("")
    number = F.when(F.col("page").isNotNull(), _header("X-Page-ID", F.col("page").cast("string"))).otherwise("")
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF + CRLF))
    digest = _header("WARC-Payload-Digest", F.col("digest"))
    refers = F.when(F.col("revisit"), F.concat(
        _header("WARC-Profile", F.lit(IDENTICAL)),
        _header("WARC-Refers-To", _urn("response", F.col("last_key"))),
    )).otherwise("")
    http = _header("Content-Type", F.when(F.col("kind") == "request", "application/http; msgtype=request").otherwise(
        "application/http; msgtype=response"))
    concurrent = _header("WARC-Concurrent-To", capture)
    asked = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)", 2)
    host = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    request = F.concat(F.lit("GET "), F.when(asked == "", "/").otherwise(asked), F.lit(f" HTTP/1.1{CRLF}Host: "), host,
                       F.lit(CRLF + CRLF))
    record = F.when(
        F.col("kind") == "request",
        _record(F.lit("request"), _urn("request", F.col("key")), [moment, target, concurrent, http], request),
    ).when(
        F.col("kind") == "metadata",
        _record(F.lit("metadata"), _urn("metadata", F.col("key")),
                [moment, target, concurrent, _header("Content-Type", F.lit("application/warc-fields"))],
                F.concat(number, _header("payload-bytes", F.col("size").cast("string")))),
    ).otherwise(
        _record(F.when(F.col("revisit"), "revisit").otherwise("response"), capture,
                [moment, target, number, refers, digest, http],
                F.when(F.col("revisit"), head).otherwise(F.concat(head, F.col("html")))),
    )
    rows.withColumn("kind", F.explode(F.array(*map(F.lit, ("request", "response", "metadata"))))).select(
        record.alias("value")
    ).write.option("lineSep", CRLF * 2).option("compression", "gzip").option(
        "maxRecordsPerFile", records_per_file).text(path)


_BLOCK_END = re.compile(rb"\r?\n\r?\n")


class RecordParser:
    """Records out of an archive's bytes, fed piece by piece; what is held is the record that is not complete yet.

    A record ends where its length says, whatever its block contains.
    """

    def __init__(self) -> None:
        self.held = bytearray()
        self.head: dict[str, str] | None = None
        self.missing = 0

    def feed(self, piece: bytes) -> Iterator[tuple]:
        """The records that are complete with ``piece``, as rows of ``RECORDS``."""
        self.held += piece
        while True:
            if self.head is None:
                held = self.held.lstrip(b"\r\n")
                ends = _BLOCK_END.search(held)
                if held and not held.startswith(b"WARC/"[:len(held)]):
                    raise ValueError(f"no WARC record begins with {bytes(held[:20])!r}")
                if ends is None:
                    self.held = held
                    return
                self.head = _fields(bytes(held[:ends.start()]))
                self.held, self.missing = held[ends.end():], int(self.head["content-length"])
            if len(self.held) < self.missing:
                return
            block, self.held = bytes(self.held[:self.missing]), self.held[self.missing:]
            head, self.head = self.head, None
            yield _row(head, block)

    def finish(self) -> None:
        if self.head is not None or self.held.strip(b"\r\n"):
            raise ValueError("the last WARC record is not complete")


def _row(head: dict[str, str], block: bytes) -> tuple:
    kind, http, payload, size, digest = head["warc-type"], None, None, None, head.get("warc-payload-digest")
    page = head.get("x-page-id")
    if kind in ("response", "revisit", "request"):
        split = _BLOCK_END.search(block)
        cut = split.end() if split else len(block)
        http = block[:cut].decode("utf-8", "replace")
        if kind == "response":
            payload = block[cut:]
            size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    elif kind == "metadata":
        fields = _fields(block)
        page, size = fields.get("x-page-id"), int(fields["payload-bytes"]) if "payload-bytes" in fields else None
    return (head["warc-record-id"], kind, head.get("warc-concurrent-to"), head.get("warc-refers-to"),
            head.get("warc-target-uri"), head.get("warc-date"), int(page) if page else None,
            http, payload, size, digest.removeprefix("sha1:") if digest else None)


def parse_records(archive: bytes) -> Iterator[tuple]:
    """The records of one uncompressed archive, as rows of ``RECORDS``."""
    parser = RecordParser()
    for at in range(0, len(archive), _PIECE):
        yield from parser.feed(archive[at:at + _PIECE])
    parser.finish()


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").splitlines()
    return {name.strip().lower(): value.strip() for name, found, value in (line.partition(":") for line in lines) if found}


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``, gzipped or plain; one task streams an archive.

    A partition that holds several archives reads them one after another; each ends with a whole record.
    """
    fields = [part.split() for part in RECORDS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])
    payload = [name for name, _ in fields].index("payload")

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = RecordParser()
        for batch in batches:
            rows: list[tuple] = []
            for piece in batch.column(0):
                for row in parser.feed(piece.as_py() + _SEPARATOR):
                    rows.append(row if with_payload else (*row[:payload], None, *row[payload + 1:]))
                if len(rows) >= _ROWS_OUT:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)
        parser.finish()

    pieces = spark.read.option("recursiveFileLookup", "true").option("lineSep", CRLF * 2).text(path)
    return pieces.select(F.col("value").cast("binary")).mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: ``capture_id``, ``page_id``, the ``request``, ``response`` and ``metadata`` records, nested, and ``refers_to_page``.

    Request and metadata join the response or revisit that they are concurrent to; where
    there is none of a kind, its column is null.  Of several of one kind the smallest is taken.  ``page_id`` is what
    the metadata says, ``refers_to_page`` the page id of the response that a revisit refers to.
    """
    def side(kind: str) -> DataFrame:
        return records.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias("capture_id")).agg(
            F.min(F.struct("record_id", "target", "date", "page_id", "http_head", "payload_bytes")).alias(kind))

    answers = records.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"), F.struct(
            "record_id", "type", "refers_to", "target", "date", "page_id", "http_head", "payload",
            "payload_bytes", "payload_digest").alias("response"))
    captures = answers.join(side("request"), "capture_id", "left").join(side("metadata"), "capture_id", "left").withColumn(
        "page_id", F.col("metadata.page_id"))
    # Only records that something refers to are looked up, each once.
    named = records.where("refers_to IS NOT NULL").select(F.col("refers_to").alias("__named")).distinct()
    targets = records.where(F.col("type") == "response").join(
        named, F.col("record_id") == F.col("__named"), "left_semi").groupBy("record_id").agg(
        F.min("page_id").alias("refers_to_page")).withColumnRenamed("record_id", "__target")
    return captures.join(targets, F.col("response.refers_to") == F.col("__target"), "left").drop("__target")
