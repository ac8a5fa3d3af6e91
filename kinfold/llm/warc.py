"""WARC archives of page captures: written by tasks, read back, and assembled into one nested row per capture.

A capture is three records: the request, the response (or, for a payload seen before, a revisit of the first
response), and metadata. Request and metadata name the response in WARC-Concurrent-To; assembly joins on it.
Archives hold one gzip member per record and are cut at a size, so that tasks stream them both ways.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import cut_lineage, new_folder, open_folder, publish
from kinfold.operators.merge import join_on

ARCHIVE_BYTES = 64 << 20
DATE = "2000-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*names) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ':'.join(map(str, names)))}>"


def _record(kind: str, ident: str, headers: list[tuple[str, str | None]], content_type: str, block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {ident}", f"WARC-Date: {DATE}",
             *[f"{k}: {v}" for k, v in headers if v is not None],
             f"Content-Type: {content_type}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def _capture(page, copy: int, url, html, first) -> bytes:
    """The three records of one page, each a gzip member."""
    payload = (html or "").encode()
    uri = None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    sha1 = payload_digest(payload)
    own, target, digest = record_id("response", page, sha1, copy), [("WARC-Target-URI", uri)], ("WARC-Payload-Digest", f"sha1:{sha1}")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    near = [*target, ("WARC-Concurrent-To", own)]
    if first is None:
        main = _record("response", own, [*target, digest], "application/http; msgtype=response", head + payload)
    else:
        main = _record("revisit", own, [
            *target, digest, ("WARC-Refers-To", record_id("response", first, sha1, 1)),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")],
            "application/http; msgtype=response", head)
    request = _record("request", record_id("request", page, sha1, copy), near, "application/http; msgtype=request",
                      f"GET {uri or '/'} HTTP/1.1\r\n\r\n".encode())
    fields = "" if page is None else f"pageId: {page}\r\n"
    metadata = _record("metadata", record_id("metadata", page, sha1, copy), near, "application/warc-fields", fields.encode())
    return b"".join(gzip.compress(r, 6, mtime=0) for r in (request, main, metadata))


def _write(batches, folder: str, archive_bytes: int):
    files, path = open_folder(folder)
    context = TaskContext.get()
    part, attempt = context.partitionId(), context.taskAttemptId()
    names, blocks, size = [], [], 0

    def close():
        names.append(f"captures-{part:06d}-{len(names):05d}.warc.gz")
        publish(files, path, names[-1], str(attempt), blocks)

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "copy", "url", "html", "first"))):
            blocks.append(_capture(*row))
            size += len(blocks[-1])
            if size >= archive_bytes:
                close()
                blocks, size = [], 0
    if blocks:
        close()
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["archive"])


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html; other columns are ignored) as archives; gives their names, one per row.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the least page_id is a response and the
    others revisit it. A null html is an empty payload, a null url a record without target. Repeated rows are
    captures of their own; a repeat of the least page is a response too. A null page_id comes after all others.
    A task that runs again writes the same files: its rows are in a fixed order.
    """
    own = pages.select("page_id", "url", "html").withColumn("sha", F.sha1(F.coalesce("html", F.lit("")).cast("binary")))
    own = own.withColumn("spread", F.xxhash64("sha"))
    firsts = own.filter(F.coalesce(F.octet_length("html"), F.lit(0)) >= least_bytes).groupBy("sha", "spread").agg(
        F.min("page_id").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Copies of a row are numbered where the join has put them; a hot payload is split by the join.
    copies = Window.partitionBy("sha", "spread", "page_id").orderBy("url")
    joined = own.join(firsts, ["sha", "spread"], "left").withColumn("copy", F.row_number().over(copies))
    rows = joined.select("page_id", "copy", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("least")),
                                                                  F.col("least")).alias("first"))
    return cut_lineage(rows.sortWithinPartitions("page_id", "copy", "url", "html").mapInArrow(
        lambda batches: _write(batches, folder, archive_bytes), "archive string"))


_RECORD = pa.schema([("kind", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.string()),
                     ("refers_to", pa.string()), ("target_uri", pa.string()), ("digest", pa.string()),
                     ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
RECORD = ("kind string, record_id string, concurrent_to string, refers_to string, target_uri string, digest string, "
          "fields map<string, string>, payload binary")


def _headers(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines)}


def parse_records(stream):
    """The records of one archive as dicts of _RECORD's columns."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a record: {line[:80]!r}")
        lines = []
        while (line := stream.readline()).strip():
            lines.append(line)
        headers = _headers(lines)
        block, kind = stream.read(int(headers["content-length"])), headers["warc-type"]
        payload, fields = None, {}
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            fields = _headers([x for x in block.splitlines() if x])
        digest = headers.get("warc-payload-digest")
        yield {"kind": kind, "record_id": headers["warc-record-id"], "concurrent_to": headers.get("warc-concurrent-to"),
               "refers_to": headers.get("warc-refers-to"), "target_uri": headers.get("warc-target-uri"),
               "digest": digest and digest.removeprefix("sha1:"), "fields": list(fields.items()), "payload": payload}


def _read(batches, folder: str, step_bytes: int = 8 << 20):
    files, path = open_folder(folder)
    for batch in batches:
        for name in batch.column("archive").to_pylist():
            rows, size = [], 0
            with files.open_input_stream(f"{path}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for record in parse_records(stream):
                    rows.append(record)
                    size += len(record["payload"] or b"") + 500
                    if size > step_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)


def _measure(batches):
    """Records without their payloads, but with its length and digest."""
    for batch in batches:
        payloads = batch.column("payload").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [*batch.drop_columns(["payload"]).columns, pa.array([None if p is None else len(p) for p in payloads], pa.int64()),
             pa.array([None if p is None else payload_digest(p) for p in payloads], pa.string())],
            [*batch.schema.names[:-1], "payload_bytes", "payload_digest"])


def read_records(archives: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """All records of the archives; ``payloads=False`` gives their payload's length and digest in its place."""
    files = max(1, archives.count())
    named = archives.repartition(files)
    if payloads:
        return named.mapInArrow(lambda batches: _read(batches, folder), RECORD)
    return named.mapInArrow(lambda batches: _measure(_read(batches, folder)), RECORD.replace(
        "payload binary", "payload_bytes bigint, payload_digest string"))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit, request and metadata nested, and the capture it revisits.

    Records meet through WARC-Concurrent-To; a capture without request or metadata has nulls there, and records
    that name no capture of the input are left out. Several requests of one capture make several rows.
    """
    nested = lambda kind, key: records.filter(F.col("kind") == kind).select(
        F.col(key).alias("record_id"), F.struct(*records.columns).alias(kind))
    main = records.filter("kind IN ('response', 'revisit')").select(
        "record_id", F.col("refers_to").alias("seen_id"), F.struct(*records.columns).alias("capture"))
    joined = main
    for kind in ("request", "metadata"):
        joined = joined.join(nested(kind, "concurrent_to"), "record_id", "left")
    # Very many captures can revisit one response; this join splits them.
    seen = joined.filter("capture.kind = 'response'").select(
        F.col("record_id").alias("seen_id"), F.struct("capture", "request", "metadata").alias("revisited"))
    again = join_on(joined.filter("seen_id IS NOT NULL"), seen, "seen_id")
    new = joined.filter("seen_id IS NULL").withColumn("revisited", F.lit(None).cast(seen.schema["revisited"].dataType))
    return new.unionByName(again).drop("seen_id")


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages written as archives in the shared folder and read back as one row per capture, payloads measured."""
    folder = new_folder(spark, "warc")
    archives = write_archives(pages, folder, least_bytes)
    return assemble(cut_lineage(read_records(archives, folder, payloads=False)))
