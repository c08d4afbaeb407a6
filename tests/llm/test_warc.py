import gzip
import hashlib
import subprocess

from propensity.llm import warc
from propensity.session import shared_path

DDL = "page_id long, url string, html string, digest string, rid int, first string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DDL)


def test_round_trip_and_edges(spark):
    big = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n</p>" * 20
    rows = [(3, "http://a/\r\nX: y", big), (1, "http://b", big), (2, None, big), (4, "http://c", None), (5, "http://d", ""), (6, "http://e", "short"),
            (7, "http://f", "short"), (None, "http://g", big), (None, None, None), (8, "u", "x" * 300_000), (9, "v", "x" * 100), (10, "w", "x" * 100),
            (11, "w", "x" * 99), (12, "w", "x" * 99)]
    got = warc.warc_round_trip(frame(spark, rows), payloads=True).collect()
    assert len(got) == len(rows)
    first = {big: 1, "x" * 100: 9}
    want = sorted(((i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), *(
        ("revisit", first[h]) if h in first and i != first[h] else ("response", None))) for i, _, h in rows), key=repr)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == want
    for r in got:
        assert r.request.concurrent_to == r.metadata.concurrent_to == r.capture_id == r.response.record_id
        if r.record_type == "response":
            assert len(r.response.payload.encode()) == r.payload_bytes


def test_repeated_rows_are_captures(spark):
    got = warc.warc_round_trip(frame(spark, [(1, "u", "z" * 200)] * 5)).collect()
    assert sorted(r.record_type for r in got) == ["response"] + ["revisit"] * 4
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {1}


def test_empty(spark):
    assert warc.warc_round_trip(frame(spark, [])).count() == 0


def test_files_are_plain_warc(spark):
    path = shared_path(spark, "warc-test-files")
    warc.write_warc(frame(spark, [(1, "http://a", "<p>x</p>")]), path)
    name = subprocess.run(["find", path.removeprefix("file:"), "-name", "*.gz"], capture_output=True, text=True).stdout.split()
    raw = b"".join(gzip.open(n).read() for n in name)
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: request\r\n") and raw.endswith(b"\r\n\r\n")
    assert raw.count(b"WARC/1.1\r\n") == 3 and b"\r\n\r\n<p>x</p>\r\n\r\n" in raw
