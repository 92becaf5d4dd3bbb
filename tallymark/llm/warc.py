"""WARC archives as a chunked record table.

An archive is a table of rows (archive, record, chunk, data): the data of one archive, in the
order of record and chunk, is a WARC 1.0 file. A record is cut into chunks of `chunk_bytes`, so
neither the writer's output nor the reader ever holds a whole large record. The reader gets the
chunks of a record in order, keeps one chunk and the header that is being read, and carries
SHA-1 over the payload from chunk to chunk. It compares the digest with the header and raises
if they differ.

Equal payloads of `revisit_bytes` or more are stored once, as a response; the other pages become
revisit records that name it. The response is the page with the largest id.

How it is spread. Digests and sizes are built-in functions; equal payloads are found by grouping
on the digest (partial maxima first) and only digests that occur twice or more are joined back, so
payloads of single pages are not shuffled for it. Records are read by (archive, record) in any task.

Edge cases. A missing payload is empty; a missing or odd URL is written as far as a header line can
hold it; text ids are stored URL-encoded, so that any id comes back as it was; missing ids never win over others; rows with the winning id are responses even if
several rows share it; an empty table gives an empty archive and no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import frames
from tallymark.operators.staging import stage

CHUNK_BYTES = 1 << 20
ARCHIVE_BYTES = 1 << 30
REVISIT_BYTES = 1000
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_LONGEST_HEADER = 1 << 20


def _urn(*parts: Column) -> Column:
    text = F.md5(F.concat_ws("\u0001", *parts).cast("binary"))
    cuts = [F.substring(text, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _lines(*lines: Column | str) -> Column:
    """Header lines; a missing one is left out."""
    return F.concat_ws("\r\n", *[F.lit(x) if isinstance(x, str) else x for x in lines])


def write_archives(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    chunk_bytes: int = CHUNK_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write the pages as WARC records and return the table of archives in the shared folder."""
    _, size = frames.text_bytes(pages, payload_column)
    archives = max(1, -(-size // archive_bytes))
    rows = pages.select(
        pages[id_column].alias("page_id"),
        pages[url_column].cast("string").alias("url"),
        frames.plain_text(pages, payload_column).cast("binary").alias("payload"),
    ).select("*", F.octet_length("payload").alias("size"), F.sha1("payload").alias("digest"))
    repeated = (
        rows.where(F.col("size") >= revisit_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n")
    )
    equal = stage(repeated, "warc")  # of known size, so that Spark need not shuffle payloads to join a small one
    key = F.col("page_id").cast("string")
    revisit = F.coalesce(F.col("page_id") != F.col("response_id"), F.col("response_id").isNotNull())
    http = _lines("HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", F.concat(F.lit("Content-Length: "), F.col("size")), "", "")
    uri = F.regexp_replace(F.col("url"), "[\\x00-\\x20\\x7f]", "%20")
    header = _lines(
        "WARC/1.0",
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _urn(F.coalesce(key, F.lit("")), F.col("digest"))),
        "WARC-Date: 1970-01-01T00:00:00Z",
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {_PROFILE}")),
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), _urn(F.col("response_id").cast("string"), F.col("digest")))),
        F.concat(F.lit("Page-ID: "), F.url_encode(key)),
        "Content-Type: application/http; msgtype=response",
        F.concat(F.lit("Content-Length: "), F.octet_length("http") + F.octet_length("body")),
        "",
        "",
    )
    records = (
        rows.join(equal, "digest", "left")
        .withColumn("revisit", revisit)
        .withColumn("http", http)
        .withColumn("body", F.when(F.col("revisit"), F.lit("").cast("binary")).otherwise(F.col("payload")))
        .select(
            F.pmod(F.xxhash64("page_id", "digest"), F.lit(archives)).cast("int").alias("archive"),
            F.monotonically_increasing_id().alias("record"),
            F.concat(header, F.col("http")).cast("binary").alias("head"),
            "body",
            F.greatest(F.lit(1), F.ceil(F.octet_length("body") / chunk_bytes)).cast("int").alias("chunks"),
        )
    )
    none = F.lit("").cast("binary")
    chunked = records.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    table = chunked.select(
        "archive",
        "record",
        "chunk",
        F.concat(
            F.when(F.col("chunk") == 0, F.col("head")).otherwise(none),
            F.substring(F.col("body"), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)),
            F.when(F.col("chunk") == F.col("chunks") - 1, F.lit("\r\n\r\n").cast("binary")).otherwise(none),
        ).alias("data"),
    )
    return stage(table, "warc")


class _Record:
    """One record while its chunks pass by."""

    def __init__(self) -> None:
        self.buffer, self.fields, self.left, self.in_http = b"", None, 0, True
        self.sha, self.size = hashlib.sha1(), 0

    def add(self, data: bytes) -> None:
        if self.in_http:
            self.buffer += data
            if self.fields is None and b"\r\n\r\n" in self.buffer:
                head, self.buffer = self.buffer.split(b"\r\n\r\n", 1)
                first, *lines = head.decode().split("\r\n")
                if not first.startswith("WARC/"):
                    raise ValueError(f"not a WARC record: {first[:40]!r}")
                self.fields = dict(line.split(": ", 1) for line in lines)
                self.left = int(self.fields["Content-Length"])
            if self.fields is None or b"\r\n\r\n" not in self.buffer:
                if len(self.buffer) > _LONGEST_HEADER:
                    raise ValueError("a header has no end")
                return
            head, data = self.buffer.split(b"\r\n\r\n", 1)
            self.left -= len(head) + 4
            self.in_http, self.buffer = False, b""
        body = data[: self.left]
        self.left -= len(body)
        self.sha.update(body)
        self.size += len(body)

    def row(self) -> tuple:
        fields = self.fields or {}
        if self.in_http or self.left:
            raise ValueError(f"record {fields.get('WARC-Record-ID')} is cut off")
        digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
        if kind == "response" and digest != self.sha.hexdigest():
            raise ValueError(f"record {fields['WARC-Record-ID']} has another digest than its header says")
        return fields["WARC-Record-ID"], kind, fields.get("Page-ID"), self.size, digest, fields.get("WARC-Refers-To")


_READ = "record_id string, record_type string, page_id string, payload_bytes long, payload_digest string, refers_to string"


def _read(batches):
    record, last, out = None, None, []
    names = [f.split()[0] for f in _READ.split(", ")]

    def made():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64() if i == 3 else pa.string()) for i in range(len(names))], names
        )

    for batch in batches:
        keys = zip(batch.column("archive").to_pylist(), batch.column("record").to_pylist())
        for key, data in zip(keys, batch.column("data")):
            if key != last:
                if record:
                    out.append(record.row())
                record, last = _Record(), key
            record.add(data.as_py())
        if len(out) >= 1000:
            yield made()
            out = []
    if record:
        out.append(record.row())
    if out:
        yield made()


def read_archives(archives: DataFrame, id_type: T.DataType = T.LongType()) -> DataFrame:
    """One row per record; a revisit takes size and digest from the response that it names."""
    ordered = archives.repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk")
    rows = ordered.mapInArrow(_read, _READ).withColumn("page_id", F.url_decode("page_id").cast(id_type))
    named = (
        rows.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("refers_to"))
        .agg(F.max("payload_bytes").alias("full_bytes"), F.max("page_id").alias("response_id"))
    )
    return rows.join(named, "refers_to", "left").select(
        "page_id",
        F.coalesce("full_bytes", "payload_bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.col("response_id").alias("refers_to"),
    )
