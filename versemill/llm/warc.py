"""WARC archives: written from pages, read back, and put together to captures.

Every page gives a request, a response (or a revisit) and a metadata record; request and
metadata name the response in WARC-Concurrent-To. Reading walks each archive file record by
record; assembly joins the records by those identifiers and emits one nested row a capture.

Defined cases: an absent payload is empty; an absent or repeated page id gives a record of its
own for each row; equal payloads of MIN_REVISIT bytes or more have the row with the largest page
id as response (all rows of that id, if it is repeated; an absent id is the smallest); a payload
may hold any bytes, also blank lines and WARC headers; no rows give an archive without records;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from versemill.session import cut_lineage, work_folder

MIN_REVISIT = 1000
#: Rows a file: files are read whole, so their size is kept moderate.
ROWS_A_FILE = 2000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEWLINE = b"\r\n"


def record(kind: str, identifier: str, body: bytes, headers: list[tuple[str, str]]) -> bytes:
    """A record without the two line ends after it (the writer of the file adds them)."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <{identifier}>",
        f"WARC-Date: {DATE}",
        *(f"{name}: {value}" for name, value in headers),
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode() + NEWLINE * 2 + body


def plain_url(url: str | None) -> str:
    return "".join(c for c in url or "" if c.isprintable() and c != " ") or "about:blank"


def page_records(row: dict) -> list[bytes]:
    html = row["html"] or b""
    page = "" if row["page_id"] is None else str(row["page_id"])
    name = f"urn:page:{row['uid']}"
    url = plain_url(row["url"])
    host = url.split("://", 1)[-1].split("/", 1)[0]
    path = "/" + url.split("://", 1)[-1].partition("/")[2]
    asked = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    about = [("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{row['digest']}")]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head = http + f"Content-Length: {len(html)}\r\n\r\n".encode()
    kind = ("Content-Type", "application/http; msgtype=response")
    if row["refers_to"] is None:
        answer = record("response", f"{name}:response", head + html, [*about, kind])
    else:
        to = [("WARC-Refers-To", f"<urn:page:{row['refers_to']}:response>"), ("WARC-Profile", PROFILE)]
        answer = record("revisit", f"{name}:response", head, [*about, *to, kind])
    with_answer = ("WARC-Concurrent-To", f"<{name}:response>")
    request = record("request", f"{name}:request", asked, [about[0], with_answer, ("Content-Type", "application/http; msgtype=request")])
    fields = f"page-id: {page}\r\n".encode()
    metadata = record("metadata", f"{name}:metadata", fields, [about[0], with_answer, ("Content-Type", "application/warc-fields")])
    return [request, answer, metadata]


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            out = [r for row in batch.slice(start, 200).to_pylist() for r in page_records(row)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write the records of (page_id, url, html) rows as WARC files below `folder`.

    The text writer puts the record's bytes out as they are and two line ends after each, which
    is the form of a WARC file. The digest table is what is shuffled, not the pages.
    """
    rows = pages.select(
        F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").cast("binary").alias("html")
    ).withColumn("digest", F.sha1(F.coalesce("html", F.lit(b""))))
    large = rows.filter(F.length("html") >= MIN_REVISIT)
    groups = large.groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
    # Payloads that occur once need no look-up; the rest is the table of repeated payloads.
    repeated = cut_lineage(groups.filter("n > 1").select(F.col("digest").alias("_digest"), "first"))
    joined = rows.join(repeated, (F.col("digest") == F.col("_digest")) & (F.length("html") >= MIN_REVISIT), "left")
    same = F.col("page_id").eqNullSafe(F.col("first"))
    refers = F.when(F.col("_digest").isNotNull() & ~same, F.coalesce(F.col("first").cast("string"), F.lit("")))
    # The response has its page id as name, so that revisits can refer to it; every other record
    # has a name of its own, whatever page id it has.
    own = F.concat_ws("-", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.monotonically_increasing_id())
    is_first = F.col("_digest").isNotNull() & same
    uid = F.when(is_first, F.coalesce(F.col("page_id").cast("string"), F.lit(""))).otherwise(own)
    named = joined.select("page_id", "url", "html", "digest", refers.alias("refers_to"), uid.alias("uid"))
    records = named.mapInArrow(_render, "record binary")
    (
        records.select(F.col("record").cast("string"))
        .write.option("lineSep", "\r\n\r\n")
        .option("compression", "none")
        .option("maxRecordsPerFile", 3 * ROWS_A_FILE)
        .text(folder)
    )


def parse_archive(content: bytes) -> Iterator[tuple[dict[str, str], int, int]]:
    """(headers in lower case, start of the body, its end) of each record in turn."""
    at, end = 0, len(content)
    while at < end:
        if content[at : at + 2] == NEWLINE:
            at += 2
            continue
        stop = content.find(b"\r\n\r\n", at)
        if stop < 0 or content[at : at + 5] != b"WARC/":
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in content[at:stop].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        body = stop + 4
        at = body + int(headers["content-length"])
        yield headers, body, at


RECORD_FIELDS = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string,"
    " date string, payload_digest string, payload_bytes long, body_digest string, fields string, payload binary"
)


def _parse(with_payload: bool):
    def bare(value: str | None) -> str | None:
        return value.strip("<>") if value else None

    def rows(content: bytes) -> Iterator[dict]:
        for headers, start, stop in parse_archive(content):
            kind = headers.get("warc-type")
            head = start
            if "application/http" in headers.get("content-type", ""):
                cut = content.find(b"\r\n\r\n", start, stop)
                head = cut + 4 if cut >= 0 else stop
            body = memoryview(content)[head:stop]
            yield {
                "record_id": bare(headers.get("warc-record-id")),
                "record_type": kind,
                "concurrent_to": bare(headers.get("warc-concurrent-to")),
                "refers_to": bare(headers.get("warc-refers-to")),
                "target_uri": headers.get("warc-target-uri"),
                "date": headers.get("warc-date"),
                "payload_digest": (headers.get("warc-payload-digest") or "").partition(":")[2] or None,
                "payload_bytes": len(body),
                "body_digest": hashlib.sha1(body).hexdigest(),
                "fields": bytes(body).decode("utf-8", "replace") if kind == "metadata" else None,
                "payload": bytes(body) if with_payload and kind == "response" else None,
            }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            schema = pa.schema(
                [(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string()) for n in
                 (f.split()[0] for f in RECORD_FIELDS.split(","))]
            )
            for i in range(batch.num_rows):
                held = []
                for row in rows(batch.column("content")[i].as_py() or b""):
                    held.append(row)
                    if len(held) >= 1000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """One row a record of the WARC files in `folder` (RECORD_FIELDS)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(_parse(with_payload), RECORD_FIELDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: its response or revisit with its requests and metadata.

    A request or metadata record may also name another one of the same capture; such a chain is
    followed one step. Records are gathered per capture, and a capture has a handful of them.
    """
    answers = records.filter("record_type IN ('response', 'revisit')")
    others = records.filter("record_type IN ('request', 'metadata') AND concurrent_to IS NOT NULL")
    via = others.select(F.col("record_id").alias("_via"), F.col("concurrent_to").alias("_to"))
    named = others.join(via, F.col("concurrent_to") == F.col("_via"), "left").withColumn(
        "capture", F.coalesce("_to", "concurrent_to")
    )
    part = F.struct("record_id", "target_uri", "date", "fields", "payload_bytes")
    gathered = named.groupBy("capture").agg(
        F.sort_array(F.collect_list(F.when(F.col("record_type") == "request", part))).alias("requests"),
        F.sort_array(F.collect_list(F.when(F.col("record_type") == "metadata", part))).alias("metadata"),
    )
    captures = answers.join(gathered, answers["record_id"] == gathered["capture"], "left").drop("capture")
    return captures.select(
        F.col("record_id").alias("capture_id"),
        "target_uri",
        "date",
        F.struct(
            "record_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "body_digest", "payload"
        ).alias("response"),
        "requests",
        "metadata",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Captures of the archives that were written from `pages`, without payloads."""
    spark = pages.sparkSession
    folder = work_folder(spark, "warc")
    write_archives(pages, folder)
    return assemble(read_archives(spark, folder))


def capture_digests(captures: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each capture.

    Size and digest are those of the bytes that were read; a revisit has none of its own and gets
    those of the response that it refers to.
    """
    rows = cut_lineage(
        captures.select(
            "capture_id",
            F.regexp_extract(F.get("metadata", 0)["fields"], r"page-id: (-?[0-9]*)", 1).alias("page"),
            "response.record_type", "response.refers_to", "response.payload_bytes", "response.body_digest",
        )
    )
    # The records that are referred to are the smaller side, and each is one row.
    named = rows.filter("record_type = 'revisit'").select(F.col("refers_to").alias("_to")).distinct()
    targets = rows.filter("record_type = 'response'").join(named, F.col("capture_id") == F.col("_to"))
    targets = targets.groupBy("_to").agg(
        F.first("payload_bytes").alias("_bytes"), F.first("body_digest").alias("_digest"), F.first("page").alias("_page")
    )
    joined = rows.join(targets, F.col("refers_to") == F.col("_to"), "left")
    long = lambda c: F.when(F.col(c) != "", F.col(c)).cast("long")
    revisit = F.col("record_type") == "revisit"
    return joined.select(
        long("page").alias("page_id"),
        F.when(revisit, F.col("_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("_digest")).otherwise(F.col("body_digest")).alias("payload_digest"),
        "record_type",
        F.when(revisit, long("_page")).alias("refers_to"),
    )
