"""WARC archives: written by Spark's own text writer, read record by record, assembled into captures.

The text writer copies a string's bytes and ends each with a separator of our choice. With the separator CRLF CRLF a row that
holds a header block and a content block becomes a record, in any file system Spark writes to, under its commit protocol.
A capture is a response or revisit record, a request and a metadata record that name it in WARC-Concurrent-To.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import stored, unstore

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payload bytes and records of one file, as far as pages are of like sizes; files are read whole by one task each, so this bounds a task.
BYTES_PER_FILE, RECORDS_PER_FILE = 128 << 20, 20_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of a binary's SHA-1, in built-in functions: 40 bits are 8 digits."""
    h = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(h, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(kind: str, row: Column, copy: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), row, copy.cast("string")).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str | Column, record_id: Column, uri: Column, date: str, fields: list[tuple[str, Column]], content_type: str, *content: Column) -> Column:
    """A whole record but for its end; the header has the content's length in bytes. Fields that are null are left out."""
    size = sum((F.octet_length(c) for c in content[1:]), F.octet_length(content[0]))
    head = [("WARC-Type", F.lit(kind) if isinstance(kind, str) else kind), ("WARC-Record-ID", record_id), ("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri), *fields, ("Content-Type", F.lit(content_type)), ("Content-Length", size.cast("string"))]
    lines = [F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit(CRLF)), F.lit("")) for k, v in head]
    return F.concat(F.lit("WARC/1.1" + CRLF), *lines, F.lit(CRLF), *content)


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", records_per_file: int = RECORDS_PER_FILE, bytes_per_file: int = BYTES_PER_FILE) -> None:
    """Writes a request, a response or revisit, and a metadata record for each row (page_id, url, html).

    The payload is the html in UTF-8, empty where it is null. Of rows with equal payloads of ``min_bytes`` or more, that with the largest
    page_id is the response that the others revisit; rows with a null page_id come before all others. Every row is a capture of its own: of rows that repeat
    page_id and payload one is the response, and equal rows are told apart by number. Line ends in a url are left out; a null url leaves the field out. An empty
    table writes an empty archive. Other columns are ignored.
    """
    p = pages.select("page_id", F.regexp_replace("url", "[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html"))
    p = p.withColumn("same", F.md5(F.to_json(F.struct("page_id", "url", "digest"))))
    light = stored(p.select("page_id", "digest", "size", "same"), "payloads")
    pages_in, bytes_in = light.agg(F.count("*"), F.sum("size")).first()
    # equal rows are few or none; where there are some, one of each is written as often as it came
    again = light.groupBy("same").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        p = p.withColumn("copy", F.lit(1))
    else:
        more = p.join(again, "same").groupBy("same").agg(*(F.any_value(c).alias(c) for c in ("page_id", "url", "html", "digest", "size")), F.max("n").alias("n"))
        p = p.join(again, "same", "left_anti").withColumn("copy", F.lit(1)).unionByName(more.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).drop("n"))
    # Reduced before it is joined, so that a payload of very many pages is one row on this side and may be split on the other.
    shared = light.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "same")).alias("o"), F.count("*").alias("n")).where("n > 1 and o.page_id is not null")
    shared = shared.select(F.col("digest").alias("shared_digest"), F.col("o.same").alias("origin"))
    p = p.join(shared, (F.col("digest") == F.col("shared_digest")) & (F.col("size") >= min_bytes), "left")
    revisit = F.col("origin").isNotNull() & ((F.col("same") != F.col("origin")) | (F.col("copy") > 1))
    p = p.withColumn("revisit", revisit).withColumn("own", _record_id("capture", F.col("same"), F.col("copy")))
    host = F.coalesce(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), F.lit(""))
    target = F.coalesce(F.nullif(F.regexp_replace("url", "^[a-z]+://[^/?#]*", ""), F.lit("")), F.lit("/"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    refers = F.when(F.col("revisit"), _record_id("capture", F.col("origin"), F.lit(1)))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    capture = _record(
        F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")), F.col("own"), F.col("url"), date,
        [("WARC-Payload-Digest", digest), ("WARC-Refers-To", refers), ("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE)))], "application/http; msgtype=response",
        http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("html")),
    )
    to = [("WARC-Concurrent-To", F.col("own"))]
    request = _record("request", _record_id("request", F.col("same"), F.col("copy")), F.col("url"), date, to, "application/http; msgtype=request", F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF)))
    meta = _record("metadata", _record_id("metadata", F.col("same"), F.col("copy")), F.col("url"), date, to, "application/warc-fields", F.coalesce(F.concat(F.lit("pageId: "), F.col("page_id").cast("string"), F.lit(CRLF)), F.lit(CRLF)))
    rows = p.select(F.explode(F.array(request, capture, meta)).alias("value"))
    # three records a page; the html's length tells how many pages fill a file
    fit = 3 * max(1, bytes_per_file * (pages_in or 1) // max(1, bytes_in or 1))
    rows.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", min(records_per_file, fit)).text(path)
    unstore(light)


class Reader:
    """Records of one archive, read from parts of bounded size."""

    def __init__(self, data: bytes):
        self.data, self.at = memoryview(data), 0
        self.zip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None
        self.have = b""

    def more(self, want: int = 1) -> bool:
        """Adds at least ``want`` bytes to what is there, joined once whatever their number; says whether there were any."""
        out, got = [self.have], 0
        while got < want and self.at < len(self.data):
            part = self.data[self.at : self.at + (1 << 18)]
            self.at += len(part)
            if self.zip is None:
                out.append(bytes(part))
                got += len(part)
                continue
            while len(part):
                out.append(self.zip.decompress(part))
                got += len(out[-1])
                part = self.zip.unused_data
                if self.zip.eof:  # the next member, of archives with one for each record
                    self.zip = zlib.decompressobj(31)
        self.have = b"".join(out)
        return got > 0

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        start = 0
        while True:
            while (end := self.have.find(b"\r\n\r\n", start)) < 0:
                if start:
                    self.have, start = self.have[start:], 0
                if not self.more():
                    if self.have.strip():
                        raise ValueError("an archive ends inside a record")
                    return
            lines = self.have[start:end].decode("utf-8", "replace").split(CRLF)
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
            fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            size = int(fields["content-length"])
            body = end + 4
            while len(self.have) < body + size + 4:
                self.have, body, start = self.have[start:], body - start, 0
                if not self.more(body + size + 4 - len(self.have)):
                    raise ValueError("an archive ends inside a record")
            yield fields, self.have[body : body + size]
            start = body + size + 4


_FIELDS = [("record_id", pa.string()), ("type", pa.string()), ("date", pa.string()), ("target_uri", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("fields", pa.string()), ("payload", pa.binary())]
_SCHEMA = "record_id string, type string, date string, target_uri string, concurrent_to string, refers_to string, payload_digest string, payload_bytes bigint, fields string, payload binary"


def _row(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    kind = fields["warc-type"]
    payload, size, digest = None, None, fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if kind == "revisit":
            size = next((int(x[15:]) for x in head.decode("latin-1").split(CRLF) if x.lower().startswith("content-length:")), None)
            payload = None
        else:
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if digest not in (None, found):
                raise ValueError(f"the payload of {fields['warc-record-id']} does not have the digest it should")
            digest = found
    text = block.decode("utf-8", "replace") if kind == "metadata" else None
    return fields["warc-record-id"], kind, fields.get("warc-date"), fields.get("warc-target-uri"), fields.get("warc-concurrent-to"), fields.get("warc-refers-to"), digest, size, text, payload if with_payload else None


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, names: str = "{part-*,*.warc,*.warc.gz,*.gz}") -> DataFrame:
    """One row for each record of the archives below ``path``, in subfolders too, plain or gzip; a response's digest is computed from its payload and must agree with its header.

    ``names`` is the pattern of archives' names.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for content in b.column("content"):
                rows, size = [], 0
                for fields, block in Reader(content.as_py()):
                    rows.append(_row(fields, block, with_payload))
                    size += len(block) * with_payload + 500
                    if size > 8 << 20:
                        yield _batch(rows)
                        rows, size = [], 0
                yield _batch(rows)

    # Spark fills an Arrow batch up to spark.sql.execution.arrow.maxBytesPerBatch (64 MB), so that few archives go to Python at once.
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, _SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(_FIELDS)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, _FIELDS, strict=True)], [n for n, _ in _FIELDS])


def captures(records: DataFrame) -> DataFrame:
    """One nested row for each capture: (capture_id, response, requests, metadata).

    All three kinds meet on one key, the identifier that request and metadata records name as concurrent and that the capture record
    bears itself, so that the join is one grouped shuffle. A record that repeats an identifier counts once. Requests and metadata whose capture is
    missing come out with a null response. Other types of record are left out.
    """
    kind = F.col("type")
    main = kind.isin("response", "revisit")
    key = F.when(main, F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))
    whole = F.struct("record_id", "type", "date", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload")
    return records.where(main | kind.isin("request", "metadata")).groupBy(key.alias("capture_id")).agg(
        F.first(F.when(main, whole), ignorenulls=True).alias("response"),
        F.array_sort(F.collect_set(F.when(kind == "request", F.struct("record_id", "date", "target_uri")))).alias("requests"),
        F.array_sort(F.collect_set(F.when(kind == "metadata", F.struct("record_id", "date", "fields")))).alias("metadata"),
    )
