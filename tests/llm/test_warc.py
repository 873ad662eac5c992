from __future__ import annotations

import gzip
import hashlib
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybook.llm import warc
from tallybook.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import counted

BIG = "<p>" + "x" * 2000 + "</p>"
FAKE = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:0>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
ROWS = [
    (1, "http://a.example/1?x=é", BIG),
    (2, "http://a.example/2", BIG),
    (2, "http://a.example/2", BIG),
    (3, None, BIG),
    (None, "http://a.example/4", BIG),
    (5, "http://a.example/5", "small"),
    (6, "http://a.example/6", "small"),
    (7, "http://a.example/7", None),
    (8, "", ""),
    (9, "http://a.example/9", FAKE + BIG + FAKE),
    (10, "not a url\r\nX: y", FAKE),
    (11, "http://a.example/11", "é🙂" * 200_000),
    (12, "http://a.example/12", "é" * 499 + "x"),
    (13, "http://a.example/13", "é" * 499 + "x"),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*x, "response", "digest", 3) for x in ROWS]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, type string, digest string, copy int")


@pytest.fixture(scope="module")
def archive(pages, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("warc") / "archive")
    warc.write(pages, folder)
    return folder


def framed(data: bytes) -> list[tuple[dict, bytes]]:
    """A reader of its own: headers and block of each record."""
    found = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        headers = dict(x.split(": ", 1) for x in lines)
        n = int(headers["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        found.append((headers, rest[:n]))
        data = rest[n + 4 :]
    return found


def test_archives_are_plain_warc_files(archive):
    found = [x for f in Path(archive).glob("*.gz") for x in framed(gzip.decompress(f.read_bytes()))]
    assert len(found) == 3 * len(ROWS)
    ids = {h["WARC-Record-ID"]: h["WARC-Type"] for h, _ in found}
    assert len(ids) == len(found)
    for headers, block in found:
        if headers["WARC-Type"] == "response":
            payload = block.partition(b"\r\n\r\n")[2]
            assert headers["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(payload).hexdigest()
        if headers["WARC-Type"] in ("request", "metadata"):
            assert ids[headers["WARC-Concurrent-To"]] in ("response", "revisit")
        if headers["WARC-Type"] == "revisit":
            assert ids[headers["WARC-Refers-To"]] == "response"


def test_captures(spark, archive):
    rows = warc.captures(warc.read(spark, archive)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.request.head.startswith("GET ") and "source: pages" in r.metadata.head
    by_page = {re.search(r"page-id: (\d+)", r.metadata.head)[1]: r for r in rows if "page-id" in r.metadata.head}
    for page_id, url, html in ROWS:
        if page_id in (9, 10, 11):
            assert by_page[str(page_id)].response.payload == html.encode()
    assert by_page["1"].response.uri == "http://a.example/1?x=é" and by_page["3"].response.uri is None


def test_payloads(spark, archive):
    rows = warc.payloads(warc.captures(warc.read(spark, archive))).collect()
    assert counted((r.page_id, r.payload_bytes, r.payload_digest) for r in rows) == counted(
        (k, len((x or "").encode()), hashlib.sha1((x or "").encode()).hexdigest()) for k, _, x in ROWS
    )
    kinds = counted((r.page_id, r.record_type, r.refers_to) for r in rows)
    response = [(k, "response", None) for k in (3, 5, 6, 7, 8, 9, 10, 11, 12, 13)]
    revisits = [(k, "revisit", 3) for k in (1, 2, 2, None)]
    expected = counted([x for x in response if x[0] not in (12, 13)] + revisits)
    # 499 two-byte letters and one more make 999 bytes: too small to revisit
    assert kinds == expected | {(12, "response", None): 1, (13, "response", None): 1}


def test_missing_and_repeated_sides(spark):
    rows = [
        ("r1", "response", None, b"x"),
        ("q2", "request", "r1", None),
        ("q1", "request", "r1", None),
        ("m1", "metadata", "gone", None),
        ("r2", "response", None, None),
        ("q3", "request", None, None),
    ]
    records = spark.createDataFrame(
        [(i, t, c, None, None, None, None, "head", p) for i, t, c, p in rows], warc.RECORD.replace(", ", ",")
    )
    found = {r.record_id: (r.request and r.request.record_id, r.metadata) for r in warc.captures(records).collect()}
    assert found == {"r1": ("q1", None), "r2": (None, None)}


def test_no_record_is_lost_where_a_buffer_ends(spark, tmp_path):
    n = 120_000
    html = F.concat(F.repeat(F.lit("x"), (F.col("id") % 997).cast("int")), F.lit("\r\n"))
    pages = spark.range(n).select(
        F.col("id").alias("page_id"), F.format_string("http://a.example/%d", "id").alias("url"), F.concat(html, "id", F.lit("\r\n")).alias("html")
    )
    warc.write(pages, str(tmp_path / "many"))
    records = warc.read(spark, str(tmp_path / "many"))
    assert {r["type"]: r["count"] for r in records.groupBy("type").count().collect()} == {"request": n, "response": n, "metadata": n}
    read = warc.payloads(warc.captures(records)).select("page_id", "payload_bytes", "payload_digest")
    expected = pages.select("page_id", F.octet_length("html").cast("bigint"), F.sha1(F.col("html").cast("binary")))
    assert read.exceptAll(expected).count() == 0 and read.count() == n


RECORD = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:%d>\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n"


def archived(folder, *records: bytes) -> str:
    folder.mkdir()
    # a member for each record, as crawlers write them
    (folder / "a.warc.gz").write_bytes(b"".join(gzip.compress(x) for x in records))
    return str(folder)


def test_archives_of_other_writers(spark, tmp_path):
    records = [RECORD % (k, k, b"\n" * k) for k in range(5)]
    folder = archived(tmp_path / "good", *records)
    (tmp_path / "good" / "b.warc.gz").write_bytes(gzip.compress(RECORD % (9, 1, b"x")))
    rows = warc.read(spark, folder).coalesce(1).collect()
    assert sorted((r.record_id, r.head) for r in rows) == [(f"<urn:uuid:{k}>", "\n" * k) for k in range(5)] + [("<urn:uuid:9>", "x")]


@pytest.mark.parametrize(
    ("records", "said"),
    [
        ((RECORD % (1, 3, b"abcd"), RECORD % (2, 1, b"x")), "does not end at its Content-Length"),
        ((RECORD % (1, 3, b"abc"), b"junk\r\n\r\n"), "no record where the last one ended"),
        ((RECORD % (1, 3, b"abc"), (RECORD % (2, 9, b"a"))), "ends inside a record"),
        ((b"WARC/1.1\r\nWARC-Type: resource\r\n\r\nabc\r\n\r\n",), "without a Content-Length"),
    ],
)
def test_broken_archives_raise(spark, tmp_path, records, said):
    with pytest.raises(Exception, match=said):
        warc.read(spark, archived(tmp_path / "bad", *records)).collect()


def test_no_pages(spark, pages, tmp_path):
    warc.write(pages.limit(0), str(tmp_path / "none"))
    assert warc.captures(warc.read(spark, str(tmp_path / "none"))).count() == 0


def test_query_against_sql(spark, small):
    import duckdb

    rows = QUERIES["op8_warc"](spark, small)
    db = duckdb.connect()
    db.sql(f"create view pages as select * from '{small}/pages.parquet'")
    expected = db.sql(f"select {', '.join(rows.columns)} from ({ORACLES['op8_warc']})").fetchall()
    assert counted(rows.collect()) == counted(expected)
