"""WARC archives on Spark: write, read, and resolve repeated payloads to revisits.

`write_archives` stores one response record per row. `resolve_revisits` reads the
archives' headers, shuffles only those by payload digest, joins each repeated
payload to the one original response, and writes deduplicated archives with fresh
headers: revisit records from the shuffled headers alone, responses by the tasks that open the
archives, which are told only which records to leave out. `read_archives` lists the records again.

Files are written by Spark's text writer: a WARC record ends in CRLF CRLF, which is
exactly the writer's line separator, so an archive is a run of standard records in one
gzip stream. They are read back through Spark's binary reader (any store Spark reads)
and parsed by Content-Length. A file holds at most RECORDS_PER_FILE records and about FILE_BYTES
of payload: larger payloads go to files of their own with fewer records.

Defined results: null payload = empty payload; null id or URL: the header is left
out and reads back as null; CR and LF in a URL are percent-encoded. Of records with
equal payloads the largest id is the response (null ids count as smallest; of rows
that repeat the largest id one stays the response and the others revisit it). An
empty table gives archives without records. Only the named columns are read.
"""
from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm.common import BROADCAST_BYTES, batches_of, scratch, stored

RECORDS_PER_FILE = 4000
FILE_BYTES = 2 ** 30
CRLF = "\r\n"
RECORD_END = CRLF * 2
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_HEADS = pa.schema([("file", pa.string()), ("ordinal", pa.int32()), ("record_id", pa.string()),
                    ("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                    ("refers_to", pa.int64()), ("head", pa.string())])
_HEADS_DDL = ("file string, ordinal int, record_id string, page_id long, uri string, "
              "record_type string, payload_bytes long, payload_digest string, refers_to long, head string")
_RECORD = pa.schema([("value", pa.binary())])


def _now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_archives(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html") -> None:
    """One response record per row, built by column expressions: no shuffle."""
    payload = F.coalesce(df[payload_col], F.lit(""))
    url = F.replace(F.replace(df[url_col], F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    size = F.octet_length(payload)
    http = F.concat(F.lit(HTTP_HEAD), size, F.lit(RECORD_END))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: response{CRLF}WARC-Record-ID: <urn:uuid:"),
        F.expr("uuid()"), F.lit(f">{CRLF}WARC-Date: {_now()}{CRLF}"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit(CRLF)), F.lit("")),
        F.coalesce(F.concat(F.lit("X-Page-ID: "), df[id_col].cast("string"), F.lit(CRLF)), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), F.sha1(payload),
        F.lit(f"{CRLF}Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(http) + size, F.lit(RECORD_END), http, payload)
    most = df.agg(F.max(size)).first()[0] or 0
    for least, upto, records in size_classes(most):
        part = df if least == 0 and upto >= most else df.where((size >= least) & (size <= upto))
        _write(part.select(record.alias("value")), path, records)


def size_classes(most: int) -> list[tuple[int, int, int]]:
    """(least, most payload bytes, records per file) so that no file passes about FILE_BYTES; `most` is
    the largest payload. Ordinarily one class."""
    usual = FILE_BYTES // RECORDS_PER_FILE
    if most <= usual:
        return [(0, usual, RECORDS_PER_FILE)]
    return [(0, usual, RECORDS_PER_FILE), (usual + 1, most, max(1, FILE_BYTES // most))]


def _write(records: DataFrame, path: str, per_file: int = RECORDS_PER_FILE) -> None:
    (records.write.mode("append").option("lineSep", RECORD_END).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", per_file)
     .text(path))


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
            .select(F.col("path").alias("file"), "content"))


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of one file."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content)), 2 ** 20)
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            if line.strip():
                raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
            continue
        fields = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            fields[name.lower()] = value.strip()
        yield fields, stream.read(int(fields["content-length"]))


def _number(text: str | None) -> int | None:
    return int(text) if text is not None else None


def _listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                for k, (fields, block) in enumerate(parse_records(content.as_py())):
                    head, sep, payload = block.partition(b"\r\n\r\n")
                    kind = fields["warc-type"]
                    if kind == "revisit":   # the payload is stored with the original
                        size = int(head.rpartition(b":")[2])
                        digest = fields["warc-payload-digest"].partition(":")[2]
                    else:
                        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                    yield (file, k, fields["warc-record-id"], _number(fields.get("x-page-id")),
                           fields.get("warc-target-uri"), kind, size, digest,
                           _number(fields.get("x-refers-to-page-id")), (head + sep).decode("utf-8", "replace"))
    return batches_of(rows(), _HEADS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; sizes and digests of stored payloads are computed."""
    return _heads(spark, path).drop("head")


def _heads(spark: SparkSession, path: str) -> DataFrame:
    return _files(spark, path).mapInArrow(_listing, _HEADS_DDL)


def resolve_revisits(spark: SparkSession, source: str, target: str, min_bytes: int = 1000) -> None:
    """Archives in `source` -> deduplicated archives in `target`.

    Only headers are shuffled by digest; they are pre-aggregated first, so that
    a payload with very many copies sends one row per task, and the join back is an
    ordinary equi-join whose skewed partitions AQE splits. The revisit records are made of these headers. Of the
    archives' contents nothing is shuffled: their tasks write the responses anew and leave out the records whose places
    they are told. These numbers are broadcast for as many files at a time as BROADCAST_BYTES allow.
    """
    heads = stored(_heads(spark, source), "warc-heads")
    large = heads.where(F.col("payload_bytes") >= min_bytes)
    first = (large.groupBy("payload_digest", "payload_bytes")
             .agg(F.max(F.struct("page_id", "record_id", "uri")).alias("original"),
                  F.count("*").alias("n"))
             .where("n > 1").drop("n"))
    again = stored(large.join(first, ["payload_digest", "payload_bytes"])
                   .where(F.col("record_id") != F.col("original.record_id")), "warc-revisits")
    date = _now()
    count, most = again.count(), heads.agg(F.max("payload_bytes")).first()[0] or 0
    share = F.pmod(F.xxhash64("file"), F.lit(shares := max(1, -(-count * 16 // BROADCAST_BYTES))))
    for k in range(shares):
        gone: dict[str, list[int]] = {}
        for r in again.where(share == k).select("file", "ordinal").toLocalIterator():
            gone.setdefault(r.file, []).append(r.ordinal)
        files = source if shares == 1 else [r.file for r in heads.where(share == k).select("file").distinct().collect()]
        if not files:
            continue
        shared = spark.sparkContext.broadcast({f: frozenset(x) for f, x in gone.items()})
        for least, upto, records in size_classes(most):
            _write(_files(spark, files).mapInArrow(_responses(shared, date, least, upto), "value binary")
                   .select(F.col("value").cast("string")), target, records)
    _write(again.select(_revisit_record(date).alias("value")), target)


def _line(name: str, value: F.Column) -> F.Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF)), F.lit(""))


def _revisit_record(date: str) -> F.Column:
    """A revisit record: the HTTP header stays, the payload is with the original."""
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: revisit{CRLF}"), _line("WARC-Record-ID", F.col("record_id")), F.lit(f"WARC-Date: {date}{CRLF}"),
        _line("WARC-Target-URI", F.col("uri")), _line("X-Page-ID", F.col("page_id")),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit(f"{CRLF}WARC-Profile: {REVISIT_PROFILE}{CRLF}"),
        _line("WARC-Refers-To", F.col("original.record_id")), _line("WARC-Refers-To-Target-URI", F.col("original.uri")),
        _line("X-Refers-To-Page-ID", F.col("original.page_id")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length("head"),
        F.lit(RECORD_END), F.col("head"))


def _responses(gone, date: str, least: int, upto: int):
    """Archives -> their records with fresh headers, without those at the places in `gone`, of one size class."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(((r,) for b in batches for file, content in zip(b.column(0).to_pylist(), b.column(1))
                           for r in _fresh_records(content.as_py(), gone.value.get(file, frozenset()), date, least, upto)), _RECORD)
    return run


def _fresh_records(content: bytes, gone: frozenset, date: str, least: int, upto: int) -> Iterator[bytes]:
    for k, (fields, block) in enumerate(parse_records(content)):
        head, sep, payload = block.partition(b"\r\n\r\n")
        if k in gone or not least <= len(payload) <= upto:
            continue
        digest = fields.get("warc-payload-digest") or f"sha1:{hashlib.sha1(payload).hexdigest()}"
        lines = ["WARC/1.1", "WARC-Type: response", f"WARC-Record-ID: {fields['warc-record-id']}", f"WARC-Date: {date}"]
        for name, key in (("WARC-Target-URI", "warc-target-uri"), ("X-Page-ID", "x-page-id")):
            if key in fields:
                lines.append(f"{name}: {fields[key]}")
        lines += [f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response",
                  f"Content-Length: {len(block)}"]
        yield CRLF.join(lines).encode("utf-8", "surrogateescape") + b"\r\n\r\n" + block


def archive_pages(df: DataFrame, min_bytes: int = 1000, **columns: str) -> DataFrame:
    """Write the rows as archives, resolve revisits, and list the final archives."""
    spark = df.sparkSession
    crawl, target = scratch(spark, "warc-crawl"), scratch(spark, "warc-final")
    write_archives(df, crawl, **columns)
    resolve_revisits(spark, crawl, target, min_bytes)
    return read_archives(spark, target)
