"""WARC archives: written from pages, read back, assembled into captures.

Archives are gzip files of WARC records, written and read by Spark's text
source, which streams them; so any store Spark knows will do, a retried task
leaves no half-written file, and no archive is held in memory.  A record is a
request, a response (or a revisit of an earlier response with the same payload)
or metadata; requests and metadata name their response in WARC-Concurrent-To,
and joining on it assembles a capture.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.common import broadcast_if_small, settled

REVISIT_BYTES = 1000  # payloads of fewer bytes are always written
RECORDS_PER_FILE = 30_000
DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, uri string, date string, "
    "digest string, head string, payload binary"
)


def _line(name: str, value: str) -> str:
    """SQL for a header line; none if the value is NULL."""
    return f"coalesce(concat('{name}: ', {value}, '\\r\\n'), '')"


def _id(kind: str, prefix: str = "") -> str:
    """SQL for a record id made of what tells a capture apart."""
    parts = ", ".join(f"coalesce(cast({prefix}{c} as string), '-')" for c in ("page_id", "url", "digest", "copy"))
    grouped = r"regexp_replace(x, '(.{8})(.{4})(.{4})(.{4})(.{12})', '$1-$2-$3-$4-$5')"
    return f"concat('<urn:uuid:', transform(array(md5(concat_ws('|', '{kind}', {parts}))), x -> {grouped})[0], '>')"


def _record(kind: str, lines: list[str], block: str) -> str:
    head = ", ".join([f"'{VERSION_SQL}WARC-Type: '", kind, "'\\r\\n'", *lines])
    return (
        f"transform(array({block}), b -> concat({head}, 'Content-Length: ', octet_length(b), '\\r\\n\\r\\n', b))[0]"
    )


VERSION_SQL = VERSION.replace("\r\n", "\\r\\n")


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with digest, n_bytes, copy (1, 2, ... of equal rows) and, for a revisit, the response it refers to."""
    body = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", body.alias("html"), F.sha1(body.cast("binary")).alias("digest"))
    rows = rows.withColumn("n_bytes", F.octet_length("html").cast("bigint"))
    keys = settled(rows.groupBy("page_id", "url", "digest", "n_bytes").agg(F.count("*").alias("copies")))
    repeated = settled(keys.where("copies > 1"))
    if repeated.isEmpty():
        numbered = rows.withColumn("copy", F.lit(1))
    else:
        match = F.expr("p.page_id <=> k.page_id and p.url <=> k.url and p.digest = k.digest")
        once = rows.alias("p").join(repeated.alias("k"), match, "left_anti").withColumn("copy", F.lit(1))
        again = rows.alias("p").join(repeated.alias("k"), match, "left_semi")
        again = again.groupBy("page_id", "url", "digest", "n_bytes").agg(F.max("html").alias("html"), F.count("*").alias("n"))
        again = again.withColumn("copy", F.explode(F.expr("sequence(1, cast(n as int))"))).drop("n")
        numbered = once.unionByName(again)
    shared = keys.where(F.col("n_bytes") >= REVISIT_BYTES).groupBy("digest", "n_bytes")
    shared = shared.agg(F.max(F.struct("page_id", "url")).alias("first"), F.sum("copies").alias("n")).where("n > 1")
    shared = shared.select("digest", "n_bytes", "first.page_id", "first.url", F.lit(1).alias("copy"))
    shared = settled(shared.select("digest", F.struct("page_id", "url", "digest", "copy").alias("origin")))
    joined = numbered.alias("p").join(broadcast_if_small(shared, 50_000).alias("o"), F.expr("p.digest = o.digest"), "left").select("p.*", "o.origin")
    itself = "origin.page_id <=> page_id and origin.url <=> url and copy = 1"
    return joined.withColumn("origin", F.expr(f"if(origin is null or ({itself}), null, origin)"))


def records(pages: DataFrame) -> DataFrame:
    """The archive's records, a row (value) each, without the blank lines that end them."""
    captured = captures_of(pages)
    response = "if(origin is null, 'response', 'revisit')"
    uri = _line("WARC-Target-URI", "replace(replace(url, '\\r', '%0D'), '\\n', '%0A')")
    date = f"'WARC-Date: {DATE}\\r\\n'"
    digest = _line("WARC-Payload-Digest", "concat('sha1:', digest)")
    path = "coalesce(nullif(regexp_extract(uri, '^[a-z]+://[^/?#]*([^#\\\\s]*)', 1), ''), '/')"
    host = "regexp_extract(uri, '^[a-z]+://([^/?#\\\\s]*)', 1)"
    asked = f"transform(array(coalesce(url, '')), uri -> concat('GET ', {path}, ' HTTP/1.1\\r\\nHost: ', {host}, '\\r\\n\\r\\n'))[0]"
    answer = "concat('HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ', n_bytes, '\\r\\n\\r\\n'"
    fields = f"concat('source: pages\\r\\n', {_line('page-id', 'page_id')})"
    together = _line("WARC-Concurrent-To", _id("response"))
    http = "'Content-Type: application/http; msgtype={}\\r\\n'"
    made = [
        _record("'request'", [_line("WARC-Record-ID", _id("request")), together, date, uri, http.format("request")], asked),
        _record(
            response,
            [
                _line("WARC-Record-ID", _id("response")),
                _line("WARC-Refers-To", f"if(origin is null, null, {_id('response', 'origin.')})"),
                _line("WARC-Profile", f"if(origin is null, null, '{PROFILE}')"),
                date,
                uri,
                digest,
                http.format("response"),
            ],
            f"{answer}, if(origin is null, html, ''))",
        ),
        _record(
            "'metadata'",
            [_line("WARC-Record-ID", _id("metadata")), together, date, uri, "'Content-Type: application/warc-fields\\r\\n'"],
            fields,
        ),
    ]
    return captured.select(F.explode(F.expr(f"array({', '.join(made)})")).alias("value"))


def write(pages: DataFrame, folder: str) -> None:
    """Write a record of each kind for every row; of repeated rows, all.

    Of equal payloads of ``REVISIT_BYTES`` or more, the row with the largest
    page_id (NULL the least, then the largest url) is the response and the
    others revisit it.  A NULL html is the empty payload, a NULL url or page_id
    has no header; extra columns are ignored; an empty table writes no record.
    """
    out = records(pages).write.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE)
    out.option("lineSep", END).text(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The records of gzip archives, framed by their Content-Length alone.

    The text source streams an archive to one task, from its start, in pieces
    that end in a line feed.  A separator of one byte is found wherever the
    source's buffer ends (of a longer one, a partial match ahead of it hides it
    there).  What is no record from end to end raises.
    """
    parts = spark.read.option("lineSep", "\n").text(folder)
    piece = F.concat("value", F.lit("\n")).cast("binary")
    return parts.select(F.col("_metadata.file_path").alias("file"), piece.alias("value")).mapInArrow(_framed, RECORD)


def _framed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [(x.split()[0], pa.binary() if x.endswith("binary") else pa.string()) for x in RECORD.split(", ")]
    )
    current, held, need = None, bytearray(), 0
    for batch in batches:
        found = []
        for file, chunk in _chunks(batch):
            if file != current:
                _check_end(current, held)
                current, held, need = file, bytearray(), 0
            held += chunk
            at = 0
            while len(held) - at > need:
                need, record = _next(current, held, at)
                if record is None:
                    break
                found.append(record)
                at, need = at + need, 0
            del held[:at]
        yield pa.RecordBatch.from_pylist(found, schema)
    _check_end(current, held)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[str, memoryview]]:
    """The bytes of a batch, file by file; values lie behind each other in Arrow's buffer."""
    files, values = batch.column(0), batch.column(1)
    if not len(values):
        return
    kind = pa.int64() if pa.types.is_large_binary(values.type) else pa.int32()
    offsets = pa.Array.from_buffers(kind, len(values) + 1, [None, values.buffers()[1]], offset=values.offset).to_numpy()
    data = memoryview(values.buffers()[2])
    runs = pc.run_end_encode(files)
    start = 0
    for file, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
        yield file, data[offsets[start] : offsets[end]]
        start = end


def _next(file: str, held: bytearray, at: int) -> tuple[int, dict | None]:
    """The record at a place and its bytes; no record, and the bytes that must be exceeded, if it is not all there."""
    version, end = VERSION.encode(), END.encode()
    if not version.startswith(held[at : at + len(version)]):
        raise ValueError(f"{file}: no record where the last one ended")
    head = held.find(end, at)
    if head < 0:
        return len(held) - at, None
    headers = _headers(bytes(held[at + len(version) : head]))
    if not headers.get("content-length", "").isdecimal():
        raise ValueError(f"{file}: record {headers.get('warc-record-id')} without a Content-Length")
    start = head + len(end)
    stop = start + int(headers["content-length"])
    if len(held) < stop + len(end):
        return stop + len(end) - at - 1, None
    if held[stop : stop + len(end)] != end:
        raise ValueError(f"{file}: record {headers.get('warc-record-id')} does not end at its Content-Length")
    return stop + len(end) - at, _parsed(headers, bytes(held[start:stop]))


def _check_end(file: str | None, held: bytearray) -> None:
    if held:
        raise ValueError(f"{file}: ends inside a record")


def _headers(head: bytes) -> dict[str, str]:
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n"))
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def _parsed(headers: dict[str, str], block: bytes) -> dict:
    head, payload = block, None
    if "application/http" in headers.get("content-type", ""):
        head, _, payload = block.partition(END.encode())
    return {
        "record_id": headers.get("warc-record-id"),
        "type": headers.get("warc-type"),
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"),
        "uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "digest": headers.get("warc-payload-digest"),
        "head": head.decode("utf-8", "replace"),
        "payload": payload,
    }


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: response, and the request and metadata concurrent to it (NULL if missing).

    Of several requests (or metadata records) of one response, the least
    record id is taken.
    """
    answers = records.where("type in ('response', 'revisit')")
    answers = answers.select("record_id", F.struct("record_id", "type", "refers_to", "uri", "date", "digest", "head", "payload").alias("response"))
    sides = {}
    for kind in ("request", "metadata"):
        side = records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
        sides[kind] = side.groupBy("concurrent_to").agg(F.min(F.struct("record_id", "date", "head")).alias(kind))
    joined = answers.alias("a")
    for kind, side in sides.items():
        joined = joined.join(side.alias(kind), F.expr(f"a.record_id = {kind}.concurrent_to"), "left")
    return joined.select("a.record_id", "a.response", "request.request", "metadata.metadata")


def payloads(captured: DataFrame) -> DataFrame:
    """One row per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (a page_id).

    Bytes and digest are computed from the payload read; a revisit's are those
    of the response it refers to.
    """
    page = F.expr("cast(nullif(regexp_extract(metadata.head, 'page-id: (-?[0-9]+)', 1), '') as bigint)")
    rows = settled(
        captured.select(
            "record_id",
            "response.type",
            "response.refers_to",
            page.alias("page_id"),
            F.octet_length("response.payload").cast("bigint").alias("n"),
            F.sha1("response.payload").alias("sha1"),
        )
    )
    answered = rows.where("type = 'response'")
    revisits = rows.where("type = 'revisit'").alias("v").join(answered.alias("r"), F.expr("v.refers_to = r.record_id"), "left")
    plain = answered.select(
        "page_id",
        F.col("n").alias("payload_bytes"),
        F.col("sha1").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    return plain.unionByName(
        revisits.select(
            "v.page_id",
            F.col("r.n").alias("payload_bytes"),
            F.col("r.sha1").alias("payload_digest"),
            F.col("v.type").alias("record_type"),
            F.col("r.page_id").alias("refers_to"),
        )
    )
