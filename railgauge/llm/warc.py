"""Web archives: pages written as WARC/1.1 records, and captures put together again from any such records.

A capture is written as three records, a gzip member each: the response (or a revisit of an equal payload that
another record holds), its request, and a metadata record; the last two name the first one in
WARC-Concurrent-To. An archive is one row of binary text, written by Spark's text sink into a file of its
own, so it goes to any store that Spark writes to; the sink's row end is a zero byte, which is padding
after the last member.

Archives are read as whole files of a bounded size, and records become rows. Transactions are
assembled by joins: requests and metadata records are reduced to one per capture that they name (or
that names them), so that many records of one capture never meet in one place, and are then joined to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype="
FIELDS = "application/warc-fields"
CAPTURES = ["response", "revisit", "resource"]
CONTROL = re.compile(r"[\x00-\x20\x7f]")
RECORD = (
    "record_id string, record_type string, target_uri string, concurrent_to array<string>, refers_to string, "
    "headers map<string, string>, http_head string, fields map<string, string>, "
    "payload_bytes long, payload_digest string, intact boolean, archive string, number int"
)


# Writing


def _uuid(kind: str, *columns: str) -> Column:
    """A record id that is the same wherever the columns are; a null is told from an empty text."""
    texts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in columns]
    name = F.md5(F.concat_ws("\n", F.lit(kind), *texts).cast("binary"))
    return F.regexp_replace(name, "(.{8})(.{4})(.{4})(.{4})(.{12})", "<urn:uuid:$1-$2-$3-$4-$5>")


def planned(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Per row of pages: page_id, url, payload (null for a revisit), its size and digest, ids of the record and of what it revisits."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload"), "check": F.xxhash64("payload")})
    # Equal payloads have equal digests of both kinds. Partial sums leave one row per task and payload.
    same = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "check", "bytes")
    owners = same.agg(F.max(F.struct("page_id", "url")).alias("owner"), F.count("*").alias("copies")).filter("copies > 1")
    # Written, so that its size is known: a small table is broadcast, a large one merge-joined, with skewed payloads split.
    owners = written(owners.drop("copies"), "owners")
    joined = rows.join(owners, ["digest", "check", "bytes"], "left")
    here = F.col("page_id").eqNullSafe(F.col("owner.page_id")) & F.col("url").eqNullSafe(F.col("owner.url"))
    revisit = F.col("owner").isNotNull() & ~here
    return joined.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "bytes",
        "digest",
        _uuid("capture", "page_id", "url", "digest").alias("record_id"),
        _uuid("request", "page_id", "url", "digest").alias("request_id"),
        _uuid("metadata", "page_id", "url", "digest").alias("metadata_id"),
        F.when(revisit, _uuid("capture", "owner.page_id", "owner.url", "digest")).alias("refers_to"),
        F.when(revisit, F.col("owner.url")).alias("refers_to_url"),
    )


def record(kind: str, record_id: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """One record as a gzip member; headers without a value are left out."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}"]
    lines += [f"{k}: {v}" for k, v in headers.items() if v is not None]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 1, mtime=0)


def _safe(url: str | None) -> str | None:
    """A url that stays in its header line: blanks and control characters are percent-encoded."""
    return None if url is None else CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)


def capture(row: dict, date: str) -> bytes:
    """The records of one capture."""
    url, refers = _safe(row["url"]), row["refers_to"]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['bytes']}\r\n\r\n".encode()
    about = {"WARC-Date": date, "WARC-Target-URI": url}
    of_payload = "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()
    shown = {**about, "WARC-Payload-Digest": of_payload, "Content-Type": HTTP + "response"}
    if refers is None:
        out = record("response", row["record_id"], shown, head + row["payload"])
    else:
        link = {"WARC-Profile": IDENTICAL, "WARC-Refers-To": refers, "WARC-Refers-To-Target-URI": _safe(row["refers_to_url"])}
        out = record("revisit", row["record_id"], {**shown, **link}, head)
    host, _, path = (url or "").partition("://")[2].partition("/")
    asked = {**about, "WARC-Concurrent-To": row["record_id"]}
    out += record("request", row["request_id"], {**asked, "Content-Type": HTTP + "request"}, f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode())
    lines = [f"page-id: {row['page_id']}"] if row["page_id"] is not None else []
    lines += [f"payload-bytes: {row['bytes']}", ""]
    return out + record("metadata", row["metadata_id"], {**asked, "Content-Type": FIELDS}, "\r\n".join(lines).encode())


def _archives(date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                held.append(capture(batch.slice(at, 1).to_pylist()[0], date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_pydict({"value": pa.array([b"".join(held)], pa.binary())})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"value": pa.array([b"".join(held)], pa.binary())})

    return run


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000, date: str = "2000-01-01T00:00:00Z", archive_bytes: int = 8 << 20) -> None:
    """The rows of pages (page_id, url, html) as archives in a new folder.

    The payload is the html in UTF-8, empty for a null. Of rows with equal payloads of at least `least_bytes`
    bytes, that with the largest (page_id, url), nulls least, is written as response and the others as
    revisits of it; rows equal in page_id, url and html are all written alike, with the same record ids.
    Blanks and control characters of a url are percent-encoded; a null url is left out, as is a null
    page_id. An archive ends with the capture that takes it to `archive_bytes` compressed bytes. Other
    columns are ignored; an empty table gives a folder without records.
    """
    archives = planned(pages, least_bytes).mapInArrow(_archives(date, archive_bytes), "value binary")
    sink = archives.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("maxRecordsPerFile", 1)
    sink.text(path)


# Reading


def _pairs(lines: list[str]) -> list[tuple[str, str]]:
    """Name (lower-cased) and value of header lines; a line that begins with a blank goes on with the one before."""
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def _hex_digest(labelled: str | None) -> str | None:
    """The SHA-1 in a digest header as lower-case hex, from base 32 or hex."""
    kind, _, value = (labelled or "").partition(":")
    if kind.lower() != "sha1":
        return None
    if len(value) == 40:
        return value.lower()
    try:
        return base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def records(content: bytes, archive: str) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers and block of each record of an archive, plain or in gzip members; lengths decide where a block ends."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content))) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    while line := stream.readline():
        if not line.strip(b"\r\n\0"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{archive}: expected a WARC record, found {line[:40]!r}")
        lines = []
        while (line := stream.readline()).strip(b"\r\n"):
            lines.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
        headers = _pairs(lines)
        length = int(dict(headers).get("content-length", -1))
        block = stream.read(max(length, 0))
        if length < 0 or len(block) < length:
            raise ValueError(f"{archive}: a record of {length} bytes ends after {len(block)}")
        yield headers, block


def _row(headers: list[tuple[str, str]], block: bytes, archive: str, number: int) -> dict:
    """A record as a row: sizes and digests are those of the whole payload, taken from the block where it holds it."""
    known = dict(headers)
    kind, content = known.get("warc-type"), known.get("content-type", "").replace(" ", "").lower()
    row = {"record_id": known.get("warc-record-id"), "record_type": kind, "target_uri": known.get("warc-target-uri")}
    row |= {"concurrent_to": [v for k, v in headers if k == "warc-concurrent-to"], "refers_to": known.get("warc-refers-to")}
    row |= {"headers": list(known.items()), "http_head": None, "fields": None, "payload": None, "archive": archive, "number": number}
    payload, told = block, _hex_digest(known.get("warc-payload-digest"))
    if content.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        row["http_head"] = head.decode("utf-8", "replace")
    elif content.startswith(FIELDS):
        row["fields"] = list(dict(_pairs(block.decode("utf-8", "replace").splitlines())).items())
    if kind == "revisit":
        sizes = [int(v) for k, v in _pairs((row["http_head"] or "").split("\r\n")) if k == "content-length" and v.isdigit()]
        row |= {"payload_bytes": sizes[0] if sizes else None, "payload_digest": told, "intact": None}
    else:
        digest = hashlib.sha1(payload).hexdigest()
        row |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest, "intact": None if told is None else told == digest}
    return row


def _parsed(with_payload: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                archive = batch.column("path")[at].as_py()
                held, size = [], 0
                for number, (headers, block) in enumerate(records(batch.column("content")[at].as_py(), archive)):
                    held.append(_row(headers, block, archive, number))
                    size += len(block) if with_payload else 1000
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives in a folder (or that a pattern names), compressed or not.

    record_id, record_type, target_uri, concurrent_to, refers_to, headers, http_head (of a message), fields
    (of application/warc-fields), payload_bytes and payload_digest (lower-case hex SHA-1) of the whole
    payload, intact (whether the digest is the one that the header tells; null where it tells none), archive
    and number in it; with_payload adds payload. A revisit's size and digest are those its headers tell, its payload is null.
    Bodies are not decoded (chunks, content codings). Of a repeated header the last value stays, but all of
    WARC-Concurrent-To. Lengths decide where a record ends, so payloads may hold anything. A damaged
    archive stops the read and is named. An archive is read whole, up to the 2 GB of a row.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = spark.createDataFrame([], RECORD + (", payload binary" if with_payload else "")).schema
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(_parsed(with_payload, to_arrow_schema(schema)), schema)


def _least_linked(found: DataFrame, captures: DataFrame, kind: str) -> DataFrame:
    """capture_id, the record of a kind with the least id that names the capture or that it names, and how many there are."""
    some = found.filter(F.col("record_type") == kind).select("record_id", "concurrent_to", F.struct("record_id", "target_uri", "http_head", "fields", "archive", "number").alias(kind))
    naming = some.select(F.explode(F.array_distinct("concurrent_to")).alias("capture_id"), "record_id", kind)
    named = captures.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("record_id")).distinct()
    pairs = naming.unionByName(named.join(some.select("record_id", kind), "record_id"))
    return pairs.groupBy("capture_id").agg(
        F.min_by(kind, F.struct("record_id", f"{kind}.archive", f"{kind}.number")).alias(kind),
        F.count("*").alias(f"n_{kind}"),
    )


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture (a response, revisit or resource record): capture, request, metadata, and counts of the last two.

    A request or metadata record belongs to the captures that it names in WARC-Concurrent-To or that
    name it; of several the one with the least record id is shown and n_request, n_metadata count them.
    A capture without one has null and 0. Records that share a record id are captures of their own, each
    with the same request and metadata. Requests and metadata without a capture are in no row.
    """
    captures = found.filter(F.col("record_type").isin(CAPTURES))
    whole = captures.select("record_id", F.struct(*[c for c in found.columns if c not in ("fields",)]).alias("capture"))
    for kind in ("request", "metadata"):
        linked = _least_linked(found, captures.select("record_id", "concurrent_to"), kind).withColumnRenamed("capture_id", "record_id")
        whole = whole.join(linked, "record_id", "left").withColumn(f"n_{kind}", F.coalesce(f"n_{kind}", F.lit(0)))
    return whole.drop("record_id")


def page_captures(captures: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to (the page_id of the response that it revisits).

    The page_id is the one its metadata record tells, null without one.
    """
    page_id = F.col("metadata.fields")["page-id"].cast("long")
    rows = captures.select(
        page_id.alias("page_id"),
        "capture.payload_bytes",
        "capture.payload_digest",
        "capture.record_type",
        F.col("capture.record_id").alias("id"),
        F.col("capture.refers_to").alias("key"),
    )
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    # Only revisits are looked up, so that rows without a key do not meet; a key with many of them is split as a skewed join.
    revisits = rows.filter("record_type = 'revisit'")
    owners = rows.filter("record_type <> 'revisit'")
    ids = owners.groupBy(F.col("id").alias("key")).agg(F.max("page_id").alias("refers_to"))
    plain = owners.select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return plain.unionByName(revisits.join(ids, "key", "left").select(*columns, "refers_to"))
