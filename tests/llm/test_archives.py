"""Archives: what is written can be read back, and payloads are stored once."""

import hashlib

from cuadrante.llm.warc import join_originals, parse_records, read_archive, write_archive
from cuadrante.session import scratch

BIG = "é<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "y" * 1200


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS payload", "3 AS refers_to").repartition(3)


def test_round_trip(spark):
    rows = [
        (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, BIG), (4, "http://b/\r\nX: y", "small"), (5, "http://b/5", "small"), (6, "http://c", None), (7, "http://c/7", ""),
        (8, "u", "z" * 1000), (9, "u", "z" * 1000), (10, "u", "z" * 999), (11, "u", "z" * 999), (12, "u", "q" * 2000), (12, "u", "q" * 2000), (None, "u", "n" * 1500), (13, "u", "n" * 1500),
        (14, "u", "é" * 500), (15, "u", "é" * 500),
    ]
    path = scratch(spark, "warc")
    write_archive(pages(spark, rows), path, date="2024-01-01T00:00:00Z")
    read = read_archive(spark, path)
    assert read.filter("payload_digest <> declared_digest").count() == 0
    out = join_originals(read)
    large = {1: 3, 2: 3, 8: 9, None: 13, 14: 15}
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        orig = large.get(i) if len(raw) >= 1000 else None
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if orig else "response", orig))
    assert sorted(map(str, want)) == sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])) for r in out.collect())
    assert {r["url"] for r in out.filter("page_id = 4").collect()} == {"http://b/%20%20X:%20y"}


def test_equal_payloads_are_stored_once(spark):
    path = scratch(spark, "warc")
    write_archive(pages(spark, [(i, "u", BIG) for i in range(50)]), path)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    records = [r for f in files for r in parse_records(bytes(f[0]))]
    assert sum(BIG.encode() in r["block"] for r in records) == 1
    assert {r["warc-refers-to"] for r in records if r["warc-type"] == "revisit"} == {r["warc-record-id"] for r in records if r["warc-type"] == "response"}


def test_no_pages(spark):
    path = scratch(spark, "warc")
    write_archive(pages(spark, []), path)
    assert join_originals(read_archive(spark, path)).count() == 0
