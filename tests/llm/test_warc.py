import hashlib
import random

from helpers import empty, with_clashes
from pyspark.sql import functions as F

from versemill.llm import warc

PAGES = "page_id long, url string, html string"


def brute(rows):
    first, n = {}, {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 1000:
            n[h] = n.get(h, 0) + 1
            first[h] = max(first.get(h, -1), -1 if i is None else i)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        to = first.get(h) if n.get(h, 0) > 1 else None
        again = to is not None and (i if i is not None else -1) != to
        out.append((i, len(h), hashlib.sha1(h).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def result(df):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in warc.capture_digests(warc.round_trip(df)).collect()), key=repr)


def rows_of(seed):
    rng = random.Random(seed)
    stock = [rng.choice("abé漢\r\n<>") * rng.choice([10, 999, 1000, 3000]) for _ in range(8)]
    stock += ["WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 40, "\r\n\r\n" * 400, "x" * 1000]
    rows = [(i, f"http://h{i}.example/p q\r\n{i}", rng.choice(stock)) for i in range(80)]
    return rows + [(200, None, None), (201, "", ""), (202, "no scheme", "y" * 200_000), (203, "https://a/b", "y" * 200_000)]


def test_round_trip_equals_brute_force(spark):
    rows = rows_of(1)
    df = with_clashes(spark.createDataFrame(rows, PAGES), "digest", "first", "uid", "record_id")
    assert result(df) == brute(rows)


def test_absent_and_repeated_ids(spark):
    big = "z" * 1500
    rows = [(None, "a", big), (3, "a", big), (3, "a", big), (5, "a", "short"), (5, "a", "short"), (None, "b", "q" * 1200), (None, "b", "q" * 1200)]
    got = result(spark.createDataFrame(rows, PAGES))
    assert len(got) == len(rows)
    digest = hashlib.sha1(big.encode()).hexdigest()
    assert [(r[0], r[3], r[4]) for r in got if r[2] == digest] == [(3, "response", None), (3, "response", None), (None, "revisit", 3)]
    assert all(r[3] == "response" for r in got if r[2] != digest)


def test_payloads_come_back(spark, tmp_path):
    rows = rows_of(2)
    folder = f"file://{tmp_path}/archive"
    warc.write_archives(spark.createDataFrame(rows, PAGES), folder)
    captures = warc.assemble(warc.read_archives(spark, folder, with_payload=True)).collect()
    assert len(captures) == len(rows)
    payloads = {bytes(c["response"]["payload"]) for c in captures if c["response"]["record_type"] == "response"}
    assert payloads == {(h or "").encode() for _, _, h in rows}
    for c in captures:
        assert len(c["requests"]) == 1 and len(c["metadata"]) == 1
        assert c["requests"][0]["target_uri"] == c["target_uri"]


def test_records_that_name_another_one_of_the_capture(spark):
    head = "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, payload_digest string, payload_bytes long, body_digest string, fields string, payload binary"
    row = lambda i, kind, to: (i, kind, to, None, "u", "d", None, 1, "x", None, None)
    records = spark.createDataFrame(
        [row("r", "response", None), row("q", "request", "r"), row("m", "metadata", "q"), row("q2", "request", "r"), row("s", "response", None), row("o", "request", "gone"), row("n", "metadata", None)],
        head,
    )
    got = {c["capture_id"]: c for c in warc.assemble(records).collect()}
    assert set(got) == {"r", "s"}
    assert [x["record_id"] for x in got["r"]["requests"]] == ["q", "q2"] and [x["record_id"] for x in got["r"]["metadata"]] == ["m"]
    assert got["s"]["requests"] is None


def test_empty_table(spark):
    assert result(empty(spark, PAGES)) == []
    assert warc.round_trip(empty(spark, PAGES)).filter(F.col("capture_id").isNotNull()).count() == 0
