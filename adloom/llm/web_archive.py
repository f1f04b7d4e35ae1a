"""Content-addressed web archive.

Two tables make an archive: ``payloads`` holds the bytes of each distinct payload once, under their
SHA-256, and ``headers`` the exact header block of each record. Records are put together again by
a join on the digest. Digests are verified twice: on writing, every row under one SHA-256 must
agree in length, SHA-1 and a third hash; on reading, the stored bytes must give their digest again.

Of records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the largest page_id
is the response and the others revisit it; smaller payloads are responses all. A revisit record holds
no payload, but its page's payload is found through its digest like any other.

A response record is an HTTP message: a short head, then the payload. Every record has the archive's date,
a parameter, and an id of its own: a digest of page, payload and its number among rows that agree
in both. Header lines can't hold line breaks, so there a url's are written as %0A; the exact url is
kept in a column beside the header. Very long texts are payloads like any other.

A null html is an empty payload. A null page_id is below every other; among equal page_ids with equal
payloads (repeated rows) each one of the largest is a response. Null urls leave their header out. Empty
tables give empty archives. Other columns are passed over.

Equal payloads are combined in each task before anything is shuffled; in the joins, adaptive execution
splits a digest that many records share, as the other side has one row for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged

LEAST_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The page of a record, and of the record it refers to, in fields of our own.
PAGE, REFERS_TO_PAGE = "Page-ID", "Refers-To-Page-ID"
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "


@dataclass(frozen=True)
class Archive:
    payloads: DataFrame  # sha256, payload
    headers: DataFrame  # sha256, header, url


def _line(name: str, value: Column | str) -> Column:
    """A header line, or nothing where the value is null."""
    value = F.lit(value) if isinstance(value, str) else value
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record_id(page: Column, number: Column) -> Column:
    """The record id, in the form of a UUID, of the so-manieth row of a page with a payload."""
    told = F.concat_ws("|", F.coalesce(page.cast("string"), F.lit("null")), F.lower(F.hex("sha256")), number.cast("string"))
    digits = F.md5(told.cast("binary"))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _http_head(n_bytes: Column) -> Column:
    return F.concat(F.lit(HTTP_HEAD), n_bytes.cast("string"), F.lit(CRLF * 2))


def keyed(pages: DataFrame) -> DataFrame:
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "*",
        F.unhex(F.sha2("payload", 256)).alias("sha256"),
        F.octet_length("payload").cast("long").alias("n_bytes"),
        F.sha1("payload").alias("sha1"),
    )


def stored_payloads(pages: DataFrame) -> DataFrame:
    """sha256, payload, n_records, holder (the largest page_id): one row for each payload."""
    check = F.struct("n_bytes", "sha1", F.xxhash64("payload"))
    one = keyed(pages).groupBy("sha256").agg(
        F.first("payload").alias("payload"),
        F.count("*").alias("n_records"),
        F.max("page_id").alias("holder"),
        F.min(check).alias("low"),
        F.max(check).alias("high"),
    )
    clash = F.raise_error(F.concat(F.lit("two payloads have the digest "), F.hex("sha256")))
    return one.select(
        F.when(F.col("low") == F.col("high"), F.col("sha256")).otherwise(clash.cast("binary")).alias("sha256"),
        "payload",
        "n_records",
        "holder",
    )


def _headers(pages: DataFrame, payloads: DataFrame, date: str) -> DataFrame:
    shared = payloads.where(
        (F.col("n_records") > 1) & (F.octet_length("payload") >= LEAST_REVISIT)
    ).select("sha256", "holder")
    revisits = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    number = F.row_number().over(Window.partitionBy("page_id", "sha256").orderBy("url"))
    rows = keyed(pages).drop("payload").withColumn("number", number).join(shared, "sha256", "left")
    size = F.length(_http_head(F.col("n_bytes"))) + F.col("n_bytes")
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisits, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("number"))),
        _line("WARC-Date", date),
        _line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", "%0A")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisits, _record_id(F.col("holder"), F.lit(1)))),
        _line("WARC-Profile", F.when(revisits, PROFILE)),
        _line(PAGE, F.col("page_id").cast("string")),
        _line(REFERS_TO_PAGE, F.when(revisits, F.col("holder").cast("string"))),
        _line("Content-Type", F.when(~revisits, "application/http; msgtype=response")),
        _line("Content-Length", F.when(revisits, F.lit(0)).otherwise(size).cast("string")),
        F.lit(CRLF),
    )
    return rows.select("sha256", header.alias("header"), "url")


def _verified(payloads: DataFrame) -> DataFrame:
    good = F.unhex(F.sha2("payload", 256)) == F.col("sha256")
    spoilt = F.raise_error(F.concat(F.lit("stored bytes don't have the digest "), F.hex("sha256")))
    return payloads.select(
        "sha256", F.when(good, F.col("payload")).otherwise(spoilt.cast("binary")).alias("payload")
    )


def archived(pages: DataFrame, date: str = DATE) -> Archive:
    """Write the archive to the shared folder and open it for reading; ``date`` is that of its records."""
    payloads = staged(stored_payloads(pages), "payloads")
    headers = staged(_headers(pages, payloads, date), "headers")
    return Archive(_verified(payloads), headers)


def open_archive(spark: SparkSession, payload_folder: str, header_folder: str) -> Archive:
    """An archive whose two tables were written to folders of their own."""
    payloads = spark.read.schema("sha256 binary, payload binary").parquet(payload_folder)
    headers = spark.read.schema("sha256 binary, header string, url string").parquet(header_folder)
    return Archive(_verified(payloads), headers)


def field(name: str) -> Column:
    """A header field's text, or null where the record hasn't got it."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(F.col("header").contains(f"{CRLF}{name}: "), found)


def records(archive: Archive) -> DataFrame:
    """page_id, url, record_type, refers_to, digest, record_id, record (the bytes as in a WARC file) and
    payload (of the page, also where the record itself is a revisit).
    """
    head = F.encode(_http_head(F.octet_length("payload")), "UTF-8")
    body = F.when(field("WARC-Type") == "response", F.concat(head, F.col("payload"))).otherwise(F.lit(b""))
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    return archive.headers.join(archive.payloads, "sha256").select(
        field(PAGE).cast("long").alias("page_id"),
        "url",
        field("WARC-Type").alias("record_type"),
        field(REFERS_TO_PAGE).cast("long").alias("refers_to"),
        F.substring(field("WARC-Payload-Digest"), 6, 40).alias("digest"),
        field("WARC-Record-ID").alias("record_id"),
        F.concat(F.encode("header", "UTF-8"), body, end).alias("record"),
        "payload",
    )
