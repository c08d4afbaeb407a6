"""WARC archives: write captures, read them back and assemble transactions.

Each page becomes three records: a request, a response (or a revisit, if an equal payload was captured before)
and a metadata record. Request and metadata name the response in ``WARC-Concurrent-To``; the reader joins the
three through that identifier into one nested row per capture, and follows ``WARC-Refers-To`` of revisits.

Archives are written by Spark's own text writer (gzip, CRLF line ends) into the shared folder, and read with
the binary file source, so any store that Spark reaches will do. Records are cut by ``Content-Length`` while the
gzip stream is inflated; a worker holds one compressed file and one record.

Edge cases: a null html is an empty payload; null page ids are kept (they are never chosen as the response while
a page with an id has the same payload, and ``refers_to`` is then null); repeated page ids are separate captures;
of captures with equal payload and equal id the first written is the response; line ends in a url are
percent-encoded; an empty table gives an empty result; only page_id, url and html are read.
"""
from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.functions.sizing import broadcast_if_bounded
from propensity.llm.common import record_batch
from propensity.session import materialize, shared_path

MIN_REVISIT_BYTES = 100
RECORDS_PER_FILE = 20_000
READ_ROWS = 512
MAX_BROADCAST_ROWS = 200_000  # of 100 bytes
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = pa.schema([
    ("kind", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
    ("target_uri", pa.string()), ("page_id", pa.int64()), ("declared_digest", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.string()),
])
RECORD_DDL = ("kind string, record_id string, concurrent_to string, refers_to string, target_uri string, page_id long, "
              "declared_digest string, payload_digest string, payload_bytes long, payload string")


def _urn(rid: Column, kind: str) -> Column:
    h = F.md5(F.concat(F.lit(f"{kind}/"), rid.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record as text; the writer's line separator ends it. A null header value leaves the header out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{k}: "), v)) for k, v in headers]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines), F.lit("\r\n\r\n"), block, F.lit("\r\n"))


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(rid, page_id, url, html, digest, first): ``first`` is the row id of the earlier capture with the same payload.

    Digests are counted with map-side combining; only payloads seen twice reach the join, where a payload shared
    by a large part of the rows is a skewed key that Spark splits."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = materialize(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url"), html.alias("html"),
                                    F.sha2(html, 256).alias("digest"), F.octet_length(html).cast("long").alias("n"),
                                    F.monotonically_increasing_id().alias("rid")))
    least = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "rid"))
    firsts = base.where(F.col("n") >= min_bytes).groupBy("digest").agg(least.alias("_f"), F.count("*").alias("_c"))
    firsts = firsts.where("_c > 1").select("digest", F.col("_f.rid").alias("first"))
    # payloads move only if there are more repeated digests than can be sent to every executor
    joined = base.join(broadcast_if_bounded(firsts, MAX_BROADCAST_ROWS), "digest", "left")
    return joined.withColumn("first", F.when(F.col("first") != F.col("rid"), F.col("first"))).drop("n")


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one gzip archive per task (more, if a task has many records)."""
    rows = with_revisits(pages, min_bytes)
    uri = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("urn:unknown")), "\r", "%0D"), "\n", "%0A")
    uri = F.regexp_replace(uri, "\x00", "%00")
    rid, date = F.col("rid"), F.lit(DATE)
    own = _urn(rid, "capture")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit("\r\n\r\n"))
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    request = _record([("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn(rid, "request")), ("WARC-Date", date),
                       ("WARC-Target-URI", uri), ("WARC-Concurrent-To", own),
                       ("Content-Type", F.lit("application/http; msgtype=request"))],
                      F.concat(F.lit("GET "), uri, F.lit(" HTTP/1.1\r\n\r\n")))
    is_revisit = F.col("first").isNotNull()
    capture = _record([("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")), ("WARC-Record-ID", own),
                       ("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", digest),
                       ("WARC-Refers-To", F.when(is_revisit, _urn(F.col("first"), "capture"))),
                       ("WARC-Profile", F.when(is_revisit, F.lit(PROFILE))),
                       ("Content-Type", F.lit("application/http; msgtype=response"))],
                      F.when(is_revisit, http).otherwise(F.concat(http, F.col("html"))))
    fields = F.concat_ws("\r\n", F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.lit("via: crawl"), F.lit(""))
    metadata = _record([("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn(rid, "metadata")), ("WARC-Date", date),
                        ("WARC-Target-URI", uri), ("WARC-Concurrent-To", own),
                        ("Content-Type", F.lit("application/warc-fields"))], fields)
    text = rows.select(F.concat_ws("\r\n", request, capture, metadata).alias("value"))
    (text.write.option("lineSep", "\r\n").option("compression", "gzip")
         .option("maxRecordsPerFile", RECORDS_PER_FILE // 3).text(path))


def _headers(stream) -> dict[str, str] | None:
    """Header fields of the next record, or None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record starts here: {line[:60]!r}")
    out = {}
    while True:
        line = stream.readline()
        if line in (b"\r\n", b"\n", b""):
            return out
        name, _, value = line.decode("utf-8").rstrip("\r\n").partition(":")
        out[name.strip().lower()] = value.strip()


def parse_records(content: bytes, payloads: bool) -> Iterator[dict]:
    """The records of one archive. Digests and lengths come from the payload bytes read, not from headers."""
    raw = io.BytesIO(content)
    stream = gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw
    with io.BufferedReader(stream, 1 << 20) as stream:
        while (head := _headers(stream)) is not None:
            length = int(head["content-length"])
            block = stream.read(length)
            if len(block) != length:
                raise ValueError("an archive ends inside a record")
            kind = head["warc-type"]
            row = {"kind": kind, "record_id": head.get("warc-record-id"), "concurrent_to": head.get("warc-concurrent-to"),
                   "refers_to": head.get("warc-refers-to"), "target_uri": head.get("warc-target-uri"), "page_id": None,
                   "declared_digest": head.get("warc-payload-digest", "").removeprefix("sha256:") or None,
                   "payload_digest": None, "payload_bytes": None, "payload": None}
            if kind == "response":
                payload = block[block.index(b"\r\n\r\n") + 4:]
                row["payload_digest"] = hashlib.sha256(payload).hexdigest()
                row["payload_bytes"] = len(payload)
                if row["payload_digest"] != row["declared_digest"]:
                    raise ValueError(f"payload of {row['record_id']} doesn't match its digest")
                if payloads:
                    row["payload"] = payload.decode("utf-8")
            elif kind == "metadata":
                for field in block.decode("utf-8").split("\r\n"):
                    if field.startswith("page-id:"):
                        row["page_id"] = int(field[8:])
            yield row


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records below ``path``, one row each."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return record_batch(RECORD_SCHEMA, {f.name: [r[f.name] for r in rows] for f in RECORD_SCHEMA})

        for batch in batches:
            for content in batch.column("content"):
                for row in parse_records(content.as_py(), payloads):
                    rows.append(row)
                    held += len(row["payload"] or "")
                    if len(rows) >= READ_ROWS or held > (8 << 20):
                        yield flush()
                        rows.clear()
                        held = 0
        if rows:
            yield flush()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, RECORD_DDL)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, request, response, metadata), joined through concurrent-to ids."""
    fields = F.struct(*[c for c in records.columns if c != "kind"])
    key = F.coalesce("concurrent_to", "record_id").alias("capture_id")

    def part(*kinds: str) -> Column:
        return F.max(F.when(F.col("kind").isin(*kinds), F.struct(F.col("kind"), fields.alias("r"))))

    grouped = records.groupBy(key).agg(part("request").alias("request"), part("response", "revisit").alias("response"),
                                       part("metadata").alias("metadata"))
    return grouped.select("capture_id", F.col("request.r").alias("request"), F.col("response.kind").alias("record_type"),
                          F.col("response.r").alias("response"), F.col("metadata.r").alias("metadata"))


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Add the referred capture's payload facts to revisits: payload_bytes, payload_digest, refers_to (a page id)."""
    target = captures.where("record_type = 'response'").select(
        F.col("capture_id").alias("_to"), F.col("metadata.page_id").alias("_page"),
        F.col("response.payload_bytes").alias("_bytes"))
    rows = captures.join(target, F.col("response.refers_to") == F.col("_to"), "left")
    return rows.select(
        F.col("metadata.page_id").alias("page_id"), F.coalesce("response.payload_bytes", "_bytes").alias("payload_bytes"),
        F.coalesce("response.payload_digest", "response.declared_digest").alias("payload_digest"), "record_type",
        F.col("_page").alias("refers_to"), "capture_id", "request", "response", "metadata")


def warc_round_trip(pages: DataFrame, payloads: bool = False, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back, one nested row per capture."""
    import uuid
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc", spark.sparkContext.applicationId, uuid.uuid4().hex)
    write_warc(pages, path)
    return resolve_revisits(materialize(assemble(read_records(spark, path, payloads))))
