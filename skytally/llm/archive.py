"""Content-addressed WARC archive.

Payload bytes are stored once, under their SHA-256; the exact header block of
each record is stored apart from them. Records come back through a join of the
two tables, and a payload whose digest no longer matches is an error. The
records can be exported as WARC files and such files read again.
"""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytally.llm.common import arrow_map
from skytally.session import shared_folder

#: Payloads below this many bytes are never replaced by a reference.
LEAST_SHARED = 1000
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

HEADERS = "record_id long, content_key string, header string"
PAYLOADS = "content_key string, payload binary"


def _urn(page_id: Column) -> Column:
    """A record id that the page id alone decides; pages without one share an id of their own."""
    digest = F.md5(F.coalesce(page_id.cast("string"), F.lit("none")).cast("binary"))
    part = lambda start, size: F.substring(digest, start, size)
    parts = [part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(kind: str, length: Column, more: Column) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.lit(kind)),
        line("WARC-Record-ID", _urn(F.col("page_id"))),
        F.when(uri != "", line("WARC-Target-URI", uri)).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        line("X-Content-Key", F.concat(F.lit("sha256:"), "content_key")),
        more,
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", length.cast("string")),
    )


def write_archive(pages: DataFrame, path: str) -> None:
    """Write ``path/headers`` and ``path/payloads`` for pages(page_id, url, html).

    Of the pages with one payload of at least ``LEAST_SHARED`` bytes the largest
    page_id is the response and the others revisit it; where that id is on
    several rows each of them is a response, and a null id counts as the
    smallest. A null html is an empty payload, a null url leaves out its header
    line, an empty table gives an empty archive. Other columns are ignored.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select(
        "page_id",
        "url",
        payload.alias("payload"),
        F.sha2(payload, 256).alias("content_key"),
        F.sha1(payload).alias("sha1"),
        F.octet_length(payload).cast("long").alias("size"),
    )
    light = records.drop("payload")
    shared = (
        light.where(F.col("size") >= LEAST_SHARED)
        .groupBy("content_key")
        .agg(F.max("page_id").alias("first_id"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    revisits = ~F.col("page_id").eqNullSafe(F.col("first_id"))
    typed = light.join(shared, "content_key", "left").withColumn(
        "revisit", F.col("first_id").isNotNull() & revisits
    )
    refers = F.concat(
        F.lit(f"WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "),
        _urn(F.col("first_id")),
        F.lit(f"{CRLF}X-Refers-To-Page: "),
        F.col("first_id").cast("string"),
        F.lit(CRLF),
    )
    typed.select(
        F.col("page_id").alias("record_id"),
        "content_key",
        F.when(F.col("revisit"), _header("revisit", F.lit(0), refers))
        .otherwise(_header("response", F.col("size"), F.lit("")))
        .alias("header"),
    ).write.parquet(f"{path}/headers")
    records.groupBy("content_key").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")


def _verified(payloads: DataFrame) -> DataFrame:
    """The store with size and SHA-1; the read fails where bytes and key disagree."""
    sound = F.sha2("payload", 256) == F.col("content_key")
    key = F.when(sound, F.col("content_key")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest: "), "content_key"))
    )
    return payloads.select(
        key.alias("content_key"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
    )


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?m)^{name}: ([^\r\n]*)", 1)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archive: its header fields, exact header, and payload.

    A revisit carries the payload that it refers to in ``payload``; its own
    block is empty. Unused columns are never read: without ``payload`` the join
    moves only keys and digests.
    """
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    stored = _verified(spark.read.schema(PAYLOADS).parquet(f"{path}/payloads"))
    return headers.join(stored, "content_key").select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        _field("WARC-Type").alias("record_type"),
        F.expr("nullif(regexp_extract(header, '(?m)^X-Refers-To-Page: (-?[0-9]+)', 1), '')").cast("long").alias("refers_to"),
        _field("WARC-Target-URI").alias("target_uri"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("stated_digest"),
        "header",
        "payload",
    )


def _block(records: DataFrame) -> Column:
    return F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))


def export_warc(records: DataFrame, path: str) -> None:
    """The records of ``read_archive`` as gzipped WARC files.

    A record ends with two line ends, which are the separator of the text
    writer, so that executors write whole records and the driver none.
    """
    record = F.concat(F.col("header"), F.lit(CRLF), _block(records).cast("string"))
    records.select(record.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(path)


def _parse(content: bytes):
    """Records of one WARC file: (header, block). Blocks are cut by Content-Length, whatever they hold."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        header = content[at : end + 2]
        fields = dict(line.split(b": ", 1) for line in header.split(b"\r\n")[1:] if b": " in line)
        start = end + 4
        stop = start + int(fields[b"Content-Length"])
        if content[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its Content-Length says")
        yield header.decode(), content[start:stop]
        at = stop + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(header, block)`` of every record in WARC files, gzipped or not; one task holds one file."""

    def records(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                content = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                headers, blocks = zip(*_parse(content)) if content else ((), ())
                columns = [pa.array(headers, pa.string()), pa.array(blocks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["header", "block"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return arrow_map(files, records, "header string, block binary")


def archived(pages: DataFrame) -> DataFrame:
    """Write the pages to an archive in the shared folder and read it back."""
    path = shared_folder(pages.sparkSession, "archive")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
