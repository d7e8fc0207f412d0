"""Content-addressed WARC archive: payload bytes once, exact record headers apart, records rebuilt by a join.

``write_archive`` stores two tables. ``payloads`` has every distinct payload once under its SHA-256 digest.
``records`` has one row per page: the exact bytes of the WARC header and of the HTTP header, and the digest
that names the payload. Among pages with equal payloads of at least ``min_bytes`` the smallest page_id is the
response and the others are revisits of it (identical-payload-digest); smaller payloads are all responses.

``read_archive`` joins the tables to the original record bytes, parses those, and checks length, SHA-1 and
SHA-256 of every payload; damage raises an error instead of a wrong row.

Payloads are moved by page_id, which is unique, so pages sharing one payload never meet in a task; only narrow
digest rows are grouped by payload, combined before the shuffle.

Defined results: a null html is an empty payload; a null url leaves out the target header, and control characters and
spaces in a url are written as %20; a page with a null id is a response and never referred to; repeated rows
of a page are the same record repeated; extra columns are ignored; an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from broadsheet.llm.common import in_small_batches
from broadsheet.session import cut, scratch_path

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DIGEST = re.compile(rb"\r\nWARC-Payload-Digest: sha1:([A-Z2-7]+)\r\n")
_HTTP_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")
_ID = re.compile(rb"\r\nWARC-Record-ID: <urn:page:(-?\d*)>\r\n")
_REFERS = re.compile(rb"\r\nWARC-Refers-To: <urn:page:(-?\d+)>\r\n")
_TYPE = re.compile(rb"\r\nWARC-Type: (\w+)\r\n")
_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")


def _base32(digests: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in digests:
        yield part.map(lambda d: base64.b32encode(bytes.fromhex(d)).decode())


def _headers(date: str) -> tuple[Column, Column]:
    """WARC header and HTTP header of a described record, as text."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit("\r\n\r\n")
    )
    name = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("n_bytes"))
    warc = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:page:"), name, F.lit(">\r\nWARC-Date: "), F.lit(date),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("sha1"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: " + PROFILE + "\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), block.cast("string"), F.lit("\r\n\r\n"),
    )
    return warc, http


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``path``/records and ``path``/payloads."""
    source = in_small_batches(pages).select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    digest = F.sha2("payload", 256)
    base32 = pandas_udf(_base32, "string")
    heads = cut(
        source.select("page_id", "url", digest.alias("digest"), F.sha1("payload").alias("_sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
        .select("page_id", "url", "digest", "n_bytes", base32("_sha1").alias("sha1")),
        "heads",
    )
    first = heads.groupBy("digest").agg(F.min("page_id").alias("first_page")).withColumnRenamed("digest", "_digest")
    described = heads.join(first, F.col("digest") == F.col("_digest")).withColumn(
        "refers_to", F.when((F.col("n_bytes") >= min_bytes) & (F.col("page_id") != F.col("first_page")), F.col("first_page"))
    )
    warc, http = _headers(date)
    described.select(
        "page_id", warc.cast("binary").alias("header"), http.cast("binary").alias("http_header"),
        F.when(F.col("refers_to").isNull(), F.col("digest")).alias("digest"),
    ).write.option("compression", "zstd").parquet(f"{path}/records")
    stored = source.withColumn("digest", digest).select("page_id", "digest", "payload")
    # Joined and made distinct by the same two columns, so a payload is moved once.
    chosen = first.filter("first_page IS NOT NULL").select(F.col("first_page").alias("_page"), "_digest")
    named = stored.join(chosen, (F.col("page_id") == F.col("_page")) & (F.col("digest") == F.col("_digest")), "left_semi")
    # Payloads that only pages without an id have.
    unnamed = stored.filter("page_id IS NULL").join(first.filter("first_page IS NULL"), F.col("digest") == F.col("_digest"), "left_semi")
    (
        named.dropDuplicates(["page_id", "digest"]).select("digest", "payload")
        .unionByName(unnamed.dropDuplicates(["digest"]).select("digest", "payload"))
        .write.option("compression", "zstd").parquet(f"{path}/payloads")
    )


def _parsed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    def parse(record: bytes, digest: str | None) -> tuple:
        # The header ends at the first empty line; the HTTP header, which starts the block, at the next.
        header_end = record.index(b"\r\n\r\n") + 4
        header, http_end = record[:header_end], record.index(b"\r\n\r\n", header_end) + 4
        payload, tail = record[http_end:-4], record[-4:]
        kind, sha1 = _TYPE.search(header)[1], _DIGEST.search(header)[1]
        size = int(_HTTP_LENGTH.search(record[header_end:http_end])[1])
        if tail != b"\r\n\r\n" or int(_LENGTH.search(header)[1]) != len(record) - header_end - 4:
            raise ValueError("record length differs from its header")
        if kind == b"response" and (
            len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()) != sha1 or hashlib.sha256(payload).hexdigest() != digest
        ):
            raise ValueError("payload differs from its digest")
        page, refers = _ID.search(header)[1], _REFERS.search(header)
        return int(page) if page else None, size, sha1.decode(), kind.decode(), int(refers[1]) if refers else None

    for records, digests in batches:
        rows = [parse(bytes(r), d) for r, d in zip(records, digests)]
        columns = list(zip(*rows)) or [()] * 5
        yield pd.DataFrame({
            "page_id": pd.array(columns[0], dtype="Int64"), "payload_bytes": columns[1], "payload_digest": columns[2], "record_type": columns[3],
            "refers_to": pd.array(columns[4], dtype="Int64"),
        })


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, digest and the exact bytes of every record; a response without its payload is an error."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads").select(F.col("digest").alias("_digest"), "payload")
    block = F.when(F.col("digest").isNull(), F.lit(b"")).otherwise(F.coalesce("payload", F.raise_error(F.lit("payload is missing")).cast("binary")))
    whole = F.concat("header", "http_header", block, F.lit(b"\r\n\r\n"))
    # Revisits need no payload and stay out of the join.
    responses = records.filter("digest IS NOT NULL").join(payloads, F.col("digest") == F.col("_digest"), "left")
    revisits = records.filter("digest IS NULL").withColumn("payload", F.lit(None).cast("binary"))
    return responses.drop("_digest").unionByName(revisits).select("page_id", "digest", whole.alias("record"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, parsed from its bytes."""
    parsed = pandas_udf(_parsed, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return read_records(spark, path).select(parsed("record", "digest").alias("r")).select("r.*")


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write an archive into the shared folder and read it back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, min_bytes)
    return read_archive(pages.sparkSession, path)
