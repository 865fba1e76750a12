from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import warc
from tidemark.llm.common import run_folder

SCHEMA = "page_id long, url string, html string, digest string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([r + ("x", "y") for r in rows], SCHEMA)


def test_archive_round_trip(spark):
    big, small = "<p>é</p>" * 40, "<p>s</p>"
    rows = [(7, "http://a/7", big), (3, "http://a/3", big), (3, "http://a/3", big), (9, None, big),
            (1, "http://b", small), (2, "http://c", small), (4, "http://d\r\nX: y", None),
            (None, "http://e", big), (None, None, None), (5, "", ""), (6, "http://l", "é" * 300_000),
            (8, "u", "a" * 99), (10, "u", "a" * 99), (11, "u", "b" * 100), (12, "u", "b" * 100)]
    folder = run_folder(spark, "t")
    warc.write_archive(pages(spark, rows), folder)
    back = warc.read_archive(spark, folder)
    got = warc.fields(back).collect()
    want, seen = [], {}
    for p, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")):
        raw = (h or "").encode()
        d = hashlib.sha256(raw).hexdigest()
        again = len(raw) >= 100 and d in seen
        want.append((p, len(raw), d, "revisit" if again else "response",
                     seen[d] if again else None))
        seen.setdefault(d, p)
    key = repr
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    # Each distinct payload is stored once; the header block's length is exact.
    assert spark.read.parquet(f"{folder}/payloads").count() == len(
        {(h or "").encode() for _, _, h in rows})
    for r in back.select("header", "payload", warc.record_bytes().alias("rec"),
                         warc.field("Content-Length").alias("n"),
                         warc.field("WARC-Type").alias("kind")).collect():
        head, http = bytes(r.header).split(b"\r\n\r\n", 1)
        body = http + (bytes(r.payload) if r.kind == "response" else b"")
        assert head.startswith(b"WARC/1.1\r\n") and int(r.n) == len(body)
        assert bytes(r.rec) == head + b"\r\n\r\n" + body + b"\r\n\r\n"
        assert b"\r\nX: y" not in head


def test_empty_and_damaged_archives(spark):
    folder = run_folder(spark, "t")
    warc.write_archive(pages(spark, []), folder)
    assert warc.read_archive(spark, folder).count() == 0
    folder = run_folder(spark, "t")
    warc.write_archive(pages(spark, [(1, "u", "a" * 200), (2, "u", "b")]), folder)
    stored = spark.read.parquet(f"{folder}/payloads").collect()
    other = run_folder(spark, "t")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{other}/headers")
    spark.createDataFrame([(bytes(r.digest), bytes(r.payload) + b"!") for r in stored],
                          "digest binary, payload binary").write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_archive(spark, other).select(F.octet_length("payload")).collect()
    lost = run_folder(spark, "t")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{lost}/headers")
    spark.createDataFrame([], "digest binary, payload binary").write.parquet(f"{lost}/payloads")
    with pytest.raises(Exception, match="no payload for digest"):
        warc.read_archive(spark, lost).select(F.octet_length("payload")).collect()
