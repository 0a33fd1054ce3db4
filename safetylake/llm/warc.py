"""Web archives: write captures as WARC records, read them back, assemble transactions.

A capture is three records tied together by concurrent-to identifiers: the
request, the response (or a revisit of an equal payload), and metadata. Records
are written by Spark's text writer, whose line separator ends each record, so
files commit like any Spark output; they are gzip streams of plain WARC. Reading
takes whole files of a bounded number of captures and follows each record's
content length, so payloads may hold anything, WARC headers included.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import membership, numbered, staged

#: Fixed values of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = ("record_id string, type string, concurrent_to string, refers_to string, uri string, date string, "
          "digest string, payload_bytes bigint, payload_digest string, block binary")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's UTF-8 bytes: five hex digits give four characters."""
    hexed = F.sha1(payload.cast("binary"))

    def four(i: Column) -> Column:
        v = F.conv(F.substr(hexed, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(*[F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def record_id(kind: str) -> Column:
    """A URN from the kind and the capture's own number."""
    h = F.md5(F.concat_ws("|", F.lit(kind), F.col("_uid").cast("string")).cast("binary"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substr(h, F.lit(a), F.lit(n)) for a, n in
                                                            ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """Header lines (those with a null value are left out), an empty line, and the block."""
    lines = [F.concat(F.lit(f"{k}: "), v, F.lit(CRLF)) for k, v in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF))
    return F.concat(F.lit(VERSION + CRLF), *[F.coalesce(x, F.lit("")) for x in lines], length, F.lit(CRLF), block)


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", per_file: int = 4000,
          id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one capture per row to ``path``.

    Of captures with equal payloads of ``min_bytes`` or more, the one with the
    smallest id is the response (nulls first, then the row's place), the others
    are revisits without a payload that refer to it. A null html is an empty
    payload, a null url an empty target, a null id an empty one. Control
    characters of urls and ids are percent-encoded. Other columns are not read.
    """
    def line(c: Column) -> Column:
        return F.replace(F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))

    p = numbered(pages.select(F.col(id_col).alias("id"), line(F.col(url_col)).alias("url"),
                              F.coalesce(F.col(html_col), F.lit("")).alias("html")), "warc-pages")
    p = p.withColumn("bytes", F.octet_length("html"))
    # equal payloads are found by the bare digest; its text is made once, where the records are written
    digest = p.where(F.col("bytes") >= min_bytes).select("id", "_uid", F.unhex(F.sha1(F.col("html").cast("binary"))).alias("sha"))
    first = staged(
        digest.groupBy("sha").agg(F.min(F.struct("id", "_uid")).alias("m"), F.count("*").alias("c"))
        .where("c > 1").select("sha", F.col("m._uid").alias("first")), "warc-first")
    revisits = staged(digest.select("_uid", "sha").join(first.hint("shuffle_hash"), "sha")
                      .where("first <> _uid").select("_uid", "first"), "warc-revisits")
    p = p.withColumn("sha", base32_sha1(F.col("html")))
    # only pages that may be revisits go through the join; the others are written where they are read
    maybe = membership(revisits, F.col("_uid"))
    p = (p.where(maybe(F.col("_uid"))).join(revisits.hint("shuffle_hash"), "_uid", "left")
         .unionByName(p.where(~maybe(F.col("_uid"))), allowMissingColumns=True))
    again = F.col("first").isNotNull()
    original = F.when(again, F.transform(F.array("first"), lambda u: F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[
        F.substr(F.md5(F.concat_ws("|", F.lit("response"), u.cast("string")).cast("binary")), F.lit(a), F.lit(n))
        for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">")))[0])
    own = record_id("response")
    host = F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1)
    target = F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]*([^#]*)", 1)
    when = F.lit(date)
    sha = F.concat(F.lit("sha1:"), F.col("sha"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    request = record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", record_id("request")), ("WARC-Date", when),
         ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", own),
         ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), F.when(target == "", "/").otherwise(target), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(CRLF * 2)))
    response = record(
        [("WARC-Type", F.when(again, "revisit").otherwise("response")), ("WARC-Record-ID", own), ("WARC-Date", when),
         ("WARC-Target-URI", F.col("url")), ("WARC-Payload-Digest", sha), ("WARC-Refers-To", original),
         ("WARC-Profile", F.when(again, F.lit(PROFILE))), ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(http, F.when(again, "").otherwise(F.col("html"))))
    metadata = record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", record_id("metadata")), ("WARC-Date", when),
         ("WARC-Target-URI", F.col("url")), ("WARC-Concurrent-To", own), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat(F.lit("page-id: "), line(F.col("id")), F.lit("\r\npayload-bytes: "), F.col("bytes").cast("string"), F.lit(CRLF)))
    (p.select(F.concat_ws(CRLF * 2, request, response, metadata).alias("value"))
     .write.option("lineSep", CRLF * 2).option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path))


def parse(data: bytes) -> Iterator[tuple]:
    """Records of one archive file: ``(headers, block)``; raises where the framing is broken."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at byte {at}")
        head = {}
        for row in data[at:end].split(b"\r\n")[1:]:
            k, _, v = row.partition(b":")
            head[k.strip().lower().decode()] = v.strip().decode("utf-8")
        size = int(head["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) != size:
            raise ValueError(f"record at byte {at} is cut short")
        yield head, block
        at = end + 4 + size + 4


def read(spark: SparkSession, path: str, blocks: bool = True) -> DataFrame:
    """All records of the archives in ``path``, columns as in ``RECORD``.

    ``payload_bytes`` and ``payload_digest`` are computed from a response's own
    payload. Without ``blocks`` that column is null.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        for b in batches:
            for content in b["content"]:
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                rows = []
                for h, block in parse(data):
                    size, sha = None, None
                    if h["warc-type"] == "response":
                        payload = block.partition(b"\r\n\r\n")[2]
                        size, sha = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    keep = block if blocks or h["warc-type"] == "metadata" else None
                    rows.append((h["warc-record-id"], h["warc-type"], h.get("warc-concurrent-to"), h.get("warc-refers-to"),
                                 h.get("warc-target-uri"), h.get("warc-date"), h.get("warc-payload-digest"), size, sha, keep))
                    if len(rows) == 500:
                        yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})
                        rows = []
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id``, ``response``, ``request``, ``metadata``, ``original``.

    Requests and metadata meet the response or revisit they are concurrent to;
    of several the smallest record id counts. Records whose counterpart is
    missing form a capture without ``response``. ``original`` is the capture that
    a revisit refers to, null where it is not in the archives.
    """
    whole = F.struct(*records.columns)
    main = records.where("type IN ('response', 'revisit')").groupBy(F.col("record_id").alias("capture_id")).agg(F.min(whole).alias("response"))

    def part(kind: str) -> DataFrame:
        return (records.where((F.col("type") == kind) & F.col("concurrent_to").isNotNull())
                .groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min(whole).alias(kind)))

    joined = staged(main.join(part("request"), "capture_id", "full").join(part("metadata"), "capture_id", "full"), "warc-captures")
    original = joined.where("response.type = 'response'").select(
        F.col("capture_id").alias("original_id"), F.struct("capture_id", "response", "metadata").alias("original"))
    again = joined.where("response.refers_to IS NOT NULL")
    return (again.withColumn("original_id", F.col("response.refers_to"))
            .join(original.hint("shuffle_hash"), "original_id", "left").drop("original_id")
            .unionByName(joined.where("response.refers_to IS NULL")
                         .withColumn("original", F.lit(None).cast(original.schema["original"].dataType))))


def field(metadata: Column, name: str) -> Column:
    """A value of a ``application/warc-fields`` block."""
    return F.regexp_extract(metadata["block"].cast("string"), rf"(?m)^{name}: ([^\r\n]*)", 1)


def report(captures: DataFrame, id_col: str = "page_id", id_type: str = "bigint") -> DataFrame:
    """Per capture: page id, bytes and digest of the full payload, record type, page of the response it revisits."""
    def page(m: str) -> Column:
        return F.when(field(F.col(m), "page-id") != "", field(F.col(m), "page-id")).cast(id_type)

    again = F.col("response.type") == "revisit"
    return captures.where("response IS NOT NULL").select(
        page("metadata").alias(id_col),
        # of a revisit: its original's, or what its own fields say where that is not in the archives
        F.when(again, F.coalesce(F.col("original.response.payload_bytes"), field(F.col("metadata"), "payload-bytes").cast("bigint")))
        .otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(again, F.coalesce(F.col("original.response.payload_digest"), F.substring_index("response.digest", ":", -1)))
        .otherwise(F.col("response.payload_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(again, page("original.metadata")).alias("refers_to"))
