import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from orderline_kpi.llm import warc
from orderline_kpi.llm.queries import QUERIES
from llm_fixtures import documents, package_for_workers  # noqa: F401

PAGES = [
    (1, "http://a.example/x?y=1#z", "<p>one</p>"), (2, "http://b.example", "<p>one</p>"), (3, None, "<p>one</p>"),
    (4, "http://c.example/", None), (5, "http://d.example/", ""), (6, "no url\r\nX-Header: 1", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n\r\n"),
    (7, "http://e.example/", "\u00e9\u65e5 \U0001f600\n" * 20_000), (8, "http://f.example/", "same"), (8, "http://f.example/", "same"),
    (None, "http://g.example/", "same"), (None, "http://h.example/", "without id"),
]


def expected(rows):
    payloads = [(page, (html or "").encode()) for page, html in rows]
    last = {}
    for page, payload in payloads:
        if page is not None:
            last[payload] = max(last.get(payload, page), page)
    return sorted(((page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                    "response" if last.get(payload) == page else "revisit", None if last.get(payload) == page else last[payload])
                   for page, payload in payloads), key=repr)


def test_whole_table(spark, tables_dir):
    pages = spark.read.parquet(f"{tables_dir}/pages.parquet").select("page_id", "html").collect()
    rows = QUERIES["op6_warc"](spark, tables_dir).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows), key=repr) == expected(pages)


def test_edge_rows_through_the_query(spark, tmp_path):
    spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3).write.parquet(
        str(tmp_path / "pages.parquet"))
    rows = QUERIES["op6_warc"](spark, str(tmp_path)).collect()
    assert sorted((tuple(row)[:5] for row in rows), key=repr) == expected([(page, html) for page, _, html in PAGES])
    assert all(row["request_id"] and row["metadata_id"] and row["request_head"].startswith("GET ") for row in rows)


def test_all_three_records_are_joined(spark, tables_dir):
    plan = QUERIES["op6_warc"](spark, tables_dir)._jdf.queryExecution().optimizedPlan().toString()
    # Request, metadata, and the response that a revisit refers to, which is looked up among those referred to.
    assert plan.count("Join ") == 4


def test_pages_that_differ_only_in_their_url_keep_their_own_requests(spark, tmp_path):
    rows = [(1, f"http://a.example/{k}", "same", "x", "y", 3) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, page string, digest string, kind int")
    warc.write_archives(pages, str(tmp_path / "archives"))
    captures = warc.assemble(warc.read_records(spark, str(tmp_path / "archives"))).collect()
    assert sorted(row["request"]["http_head"].split()[1] for row in captures) == [f"/{k}" for k in range(4)]
    assert all(row["response"]["target"] == row["request"]["target"] for row in captures)


def test_records_come_out_of_any_pieces():
    rows = [f"payload {k}\r\n\r\n".encode() * k for k in range(6)]
    archive = b"".join(
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <{k}>\r\nContent-Length: {len(p) + 19}\r\n\r\nHTTP/1.1 200 OK\r\n\r\n".encode()
        + p + b"\r\n\r\n" for k, p in enumerate(rows))
    for size in (1, 7, 64, 10_000):
        parser = warc.RecordParser()
        found = [row for at in range(0, len(archive), size) for row in parser.feed(archive[at:at + size])]
        parser.finish()
        assert [row[8] for row in found] == rows
    with pytest.raises(ValueError):
        list(warc.parse_records(archive[:-30]))


def test_a_page_of_forty_megabytes(spark, tmp_path):
    pages = spark.range(3).selectExpr("id AS page_id", "'http://a.example' AS url", "repeat(concat('page ', id, ' '), 5000000) AS html")
    warc.write_archives(pages, str(tmp_path / "archives"))
    captures = warc.assemble(warc.read_records(spark, str(tmp_path / "archives"), with_payload=False)).collect()
    assert sorted(row["response"]["payload_bytes"] for row in captures) == [35_000_000] * 3


def test_captures_are_whole_and_nested(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:7], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "archives"), records_per_file=4)
    captures = {row["response"]["page_id"]: row for row in warc.assemble(warc.read_records(spark, str(tmp_path / "archives"))).collect()}
    assert sorted(captures) == [1, 2, 3, 4, 5, 6, 7]
    for page, url, html in PAGES[:7]:
        capture = captures[page]
        assert capture["request"]["http_head"].startswith("GET /")
        assert capture["metadata"]["payload_bytes"] == len((html or "").encode())
        if capture["response"]["type"] == "response":
            assert bytes(capture["response"]["payload"]) == (html or "").encode()
        else:
            assert capture["response"]["refers_to"] == captures[3 if html else 5]["capture_id"]
            assert capture["refers_to_page"] == (3 if html else 5)
    assert captures[1]["request"]["http_head"].startswith("GET /x?y=1 HTTP/1.1\r\nHost: a.example\r\n")
    # The files themselves are plain archives.
    files = list(Path(tmp_path / "archives").glob("*.gz"))
    records = [record for file in files for record in warc.parse_records(gzip.decompress(file.read_bytes()))]
    assert len(records) == 3 * 7 and len(files) > 3


def test_small_payloads_can_all_be_responses(spark, tmp_path):
    pages = spark.createDataFrame(PAGES[:3], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "archives"), min_revisit_bytes=11)
    assert [row["type"] for row in warc.read_records(spark, str(tmp_path / "archives")).where(
        "type IN ('response', 'revisit')").collect()] == ["response"] * 3


def test_no_pages_and_broken_archives(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert QUERIES["op6_warc"](spark, str(tmp_path)).count() == 0
    with pytest.raises(ValueError):
        list(warc.parse_records(b"no archive"))
