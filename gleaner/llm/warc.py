"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-256; the exact header bytes of every record (WARC header and HTTP header)
are stored apart with that address. Joining the two gives back each record byte for byte. Every read verifies lengths
and both digests and fails on a mismatch.

Of records with equal payloads of at least ``least`` bytes the one with the largest id is the response, the others are
revisits that refer to it. Smaller payloads are responses of their own, still stored once.

Defined results: a null payload is empty. A null url has no target header; control characters in urls are percent-encoded.
Repeated rows are records of their own; rows with the largest id of their payload are all responses. A record with null id
is a revisit where the payload has an id, and a response else. Empty tables give an empty archive. Extra columns are
ignored. One payload has to fit a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import stage

LEAST_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-record:"
CRLF = "\r\n"


def _line(name: str, *value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), *value, F.lit(CRLF))


def _header(kind: Column, row_id: Column, url: Column, digest: Column, size: Column, refers: Column, date: str) -> Column:
    """WARC header and HTTP header up to the payload. The record id is ``urn:x-record:<id>``."""
    response = kind == "response"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"), _line("Content-Length", size.cast("string")), F.lit(CRLF))
    safe_url = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    block = F.octet_length(http) + F.when(response, size).otherwise(F.lit(0))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    warc = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.lit(f"<{RECORD_ID}"), text(row_id), F.lit(">")),
        F.coalesce(_line("WARC-Target-URI", safe_url), F.lit("")),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.lit("sha1:"), digest),
        F.when(response, F.lit("")).otherwise(
            F.concat(_line("WARC-Refers-To", F.lit(f"<{RECORD_ID}"), text(refers), F.lit(">")), _line("WARC-Profile", F.lit(PROFILE)))
        ),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(CRLF),
    )
    return F.concat(warc, http).cast("binary")


def write_archive(records: DataFrame, path: str, row_id: str, url: str, payload: str, least: int = LEAST_BYTES, date: str = DATE) -> None:
    """Write ``<path>/payloads`` (address, payload) and ``<path>/headers`` (header, address)."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    full = records.select(F.col(row_id).alias("id"), F.col(url).alias("url"), body.alias("payload"))
    addressed = full.withColumn("address", F.unhex(F.sha2("payload", 256)))
    addressed.select("address", "payload").dropDuplicates(["address"]).write.option("compression", "zstd").parquet(f"{path}/payloads")

    # Narrow from here on: digests and lengths only.
    told = stage(addressed.select("id", "url", "address", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("bigint").alias("size")), "warc-digests")
    per = told.groupBy("address").agg(F.max("id").alias("first_id"), F.count("*").alias("copies"), F.min("size").alias("a"), F.max("size").alias("b"), F.min("digest").alias("c"), F.max("digest").alias("d"))
    sure = per.select(
        "address",
        F.when((F.col("a") == F.col("b")) & (F.col("c") == F.col("d")), F.col("first_id")).otherwise(F.raise_error(F.lit("one address for unequal payloads"))).alias("first_id"),
    )
    typed = told.join(sure, "address").withColumn(
        "kind", F.when((F.col("size") < least) | F.col("id").eqNullSafe(F.col("first_id")), "response").otherwise("revisit")
    )
    header = _header(F.col("kind"), F.col("id"), F.col("url"), F.col("digest"), F.col("size"), F.col("first_id"), date)
    typed.select(header.alias("header"), "address").write.option("compression", "zstd").parquet(f"{path}/headers")


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """``header, address, payload``: every original record, revisits with the payload they stand for."""
    headers = spark.read.schema("header binary, address binary").parquet(f"{path}/headers")
    payloads = spark.read.schema("address binary, payload binary").parquet(f"{path}/payloads")
    return headers.join(payloads, "address", "left").select("header", "address", "payload")


def parse_header(header: bytes) -> tuple[dict[str, str], dict[str, str]]:
    """The fields of the WARC header and of the HTTP header."""
    warc, http = header.decode().split(CRLF * 2)[:2]
    first, *warc_lines = warc.split(CRLF)
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:40]!r}")
    fields = dict(x.split(": ", 1) for x in warc_lines)
    return fields, dict(x.split(": ", 1) for x in http.split(CRLF)[1:])


READ_SCHEMA = "id string, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, payload binary"


def _named(value: str | None) -> str | None:
    return value[len(RECORD_ID) + 1 : -1] or None if value else None


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of an archive, verified: ids as strings, type, url, full payload and its length and SHA-1."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for header, address, payload in zip(*(c.to_pylist() for c in batch.columns)):
                warc, http = parse_header(header)
                if payload is None or hashlib.sha256(payload).digest() != address:
                    raise ValueError(f"payload of {warc['WARC-Record-ID']} is missing or was changed")
                digest = hashlib.sha1(payload).hexdigest()
                block = len(header) - header.index(b"\r\n\r\n") - 4 + (len(payload) if warc["WARC-Type"] == "response" else 0)
                if int(http["Content-Length"]) != len(payload) or int(warc["Content-Length"]) != block or warc["WARC-Payload-Digest"] != f"sha1:{digest}":
                    raise ValueError(f"header and payload of {warc['WARC-Record-ID']} do not fit")
                rows.append((
                    _named(warc["WARC-Record-ID"]), warc.get("WARC-Target-URI"), len(payload), digest, warc["WARC-Type"],
                    _named(warc.get("WARC-Refers-To")), payload if with_payload else None,
                ))
            types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
            names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, types)], names=names)

    return reconstruct(spark, path).mapInArrow(parse, READ_SCHEMA)


def export_warc(spark: SparkSession, path: str, out: str, records_per_file: int = 10_000) -> None:
    """Write the archive as WARC files: record after record, each closed by two line ends. Revisits carry no payload."""
    joined = reconstruct(spark, path)
    revisit = F.decode("header", "UTF-8").contains(f"{CRLF}WARC-Type: revisit{CRLF}")
    record = F.concat("header", F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload")))
    # The text sink writes bytes as they are and closes each value with the separator.
    joined.select(record.cast("string").alias("value")).write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", records_per_file).text(out)


def records_in_file(content: bytes) -> list[tuple[bytes, bytes]]:
    """The (WARC header, block) pairs of one WARC file, cut by their lengths."""
    found, at = [], 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at) + 4
        header = content[at:end]
        size = int(header.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
        found.append((header, content[end : end + size]))
        at = end + size + 4
    return found
