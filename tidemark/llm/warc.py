"""Content-addressed web archive.

Three Parquet tables in a folder of the shared store: ``headers`` (one exact
header block per record), ``payloads`` (each distinct payload once, under its
SHA-256) and, by joining them, the original records.  A payload of at least
``min_revisit`` bytes that occurs again is recorded as a ``revisit`` of the
record with the smallest page id.  On reading, every payload is hashed again
and a difference ends the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIN_REVISIT_BYTES = 100
WARC_DATE = "2020-01-01T00:00:00Z"      # default of records that carry no capture time
CRLF = "\r\n"


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))


def _one_line(value: Column) -> Column:
    """Header values hold no line breaks: they are percent-encoded."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _http_head(payload_bytes: Column) -> Column:
    return F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    _line("Content-Length", payload_bytes.cast("string")), F.lit(CRLF))


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT_BYTES,
            date: str = WARC_DATE) -> DataFrame:
    """``(page_id, digest, header)``: the exact header block of every record.

    The record of a page in ``pages(page_id, url, html)``; a null html is the
    empty payload, a null url leaves its line out, a null page id gets no
    record id and comes after all others.  Of repeated rows with the smallest
    id of a payload the first (by url) is the response, the others revisit
    that id.  Further columns are ignored."""
    html = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    own = pages.select(F.col("page_id").cast("long"), "url", F.sha2(html, 256).alias("digest"),
                       F.octet_length(html).cast("long").alias("payload_bytes"))
    # One row per (payload, page, url); only narrow columns are shuffled, and
    # equal keys are combined before the shuffle.
    counted = own.groupBy("digest", "payload_bytes", "page_id", "url").agg(
        F.count("*").alias("copies"))
    large = counted.where(F.col("payload_bytes") >= min_revisit)
    first = large.groupBy("digest").agg(F.min(F.struct(
        F.col("page_id").isNull().alias("no_id"), "page_id",
        F.coalesce("url", F.lit("")).alias("at"), F.col("url").isNull().alias("no_url"),
    )).alias("first")).select(F.concat("digest", F.lit("")).alias("digest"), "first")
    led = counted.join(first, "digest", "left").withColumn("leads", (
        F.col("page_id").eqNullSafe(F.col("first.page_id"))
        & (F.coalesce("url", F.lit("")) == F.col("first.at"))
        & (F.col("url").isNull() == F.col("first.no_url"))))
    each = led.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    revisit = (F.col("payload_bytes") >= min_revisit) & ~(F.col("leads") & (F.col("copy") == 1))
    head = _http_head(F.col("payload_bytes"))
    block = F.octet_length(head).cast("long") + F.when(revisit, F.lit(0).cast("long")).otherwise(
        F.col("payload_bytes"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(CRLF), _line("WARC-Record-ID", _urn(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}{CRLF}"), _line("WARC-Target-URI", _one_line(F.col("url"))),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: "
                  "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + CRLF),
            _line("WARC-Refers-To", _urn(F.col("first.page_id"))))).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("Content-Length", block.cast("string")), F.lit(CRLF), head)
    return each.select("page_id", "digest", F.encode(header, "UTF-8").alias("header"))


def write_archive(pages: DataFrame, folder: str, min_revisit: int = MIN_REVISIT_BYTES,
                  date: str = WARC_DATE) -> None:
    """Write ``pages`` as a new archive in ``folder``; an empty table gives empty tables."""
    records(pages, min_revisit, date).write.parquet(f"{folder}/headers")
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    (pages.select(F.unhex(F.sha2(payload, 256)).alias("digest"), payload.alias("payload"))
     .groupBy("digest").agg(F.any_value("payload").alias("payload"))
     .write.option("compression", "zstd").parquet(f"{folder}/payloads"))


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, digest, header, payload)`` of every record, payloads verified."""
    headers = spark.read.schema("page_id long, digest string, header binary").parquet(
        f"{folder}/headers")
    payloads = spark.read.schema("digest binary, payload binary").parquet(f"{folder}/payloads")
    real = F.sha2("payload", 256)
    checked = payloads.select(F.lower(F.hex("digest")).alias("digest"), F.when(
        real == F.lower(F.hex("digest")), F.col("payload")).otherwise(
            F.raise_error(F.concat(F.lit("payload differs from its digest "),
                                   F.hex("digest")))).alias("payload"))
    missing = F.raise_error(F.concat(F.lit("no payload for digest "), headers["digest"]))
    return headers.join(checked, "digest", "left").select(
        "page_id", "digest", "header",
        F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(
            missing.cast("binary")).alias("payload"))


def field(name: str) -> Column:
    """A WARC header field of ``header``, or null where the record has none."""
    # The WARC block ends at the first empty line; the HTTP head follows it.
    warc = F.substring_index(F.decode("header", "UTF-8"), CRLF + CRLF, 1)
    found = F.regexp_extract(warc, rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def fields(records: DataFrame) -> DataFrame:
    """The parsed records: what the header blocks say, and the payload's own size and hash."""
    page = F.regexp_extract(F.coalesce(field("WARC-Record-ID"), F.lit("")), r"page:(-?\d+)>", 1)
    refers = F.regexp_extract(F.coalesce(field("WARC-Refers-To"), F.lit("")), r"page:(-?\d+)>", 1)
    return records.select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.substring_index(field("WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        F.when(refers != "", refers.cast("long")).alias("refers_to"))


def record_bytes() -> Column:
    """A record as it stands in a WARC file: header block, body, end.  A revisit has no body."""
    return F.concat("header", F.when(field("WARC-Type") == "response", F.col("payload"))
                    .otherwise(F.lit(b"")), F.lit(b"\r\n\r\n"))
