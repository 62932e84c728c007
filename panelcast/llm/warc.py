"""WARC derivatives of crawled pages (native columns only).

A response record holds a page as it came: HTTP status line, headers and payload. ``derivatives`` turns
each response into two records that name it in ``WARC-Refers-To`` and each other in
``WARC-Concurrent-To``: a metadata record (``application/warc-fields``: source headers, payload digest,
title, outlinks) and a plain-text conversion record. All of it is a projection of one row, so nothing is
shuffled. Record ids are URNs of MD5 digests of type, page and address: a rebuilt record keeps its id.
Digests are SHA-256 in hex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import reading

CRLF = "\r\n"
VERSION = "WARC/1.0"
DATE = "1970-01-01T00:00:00Z"
HTML_TYPE = "text/html; charset=utf-8"

# Regular expressions that Java and RE2 read alike.
HIDDEN = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"|</?(?:a|abbr|b|big|cite|code|em|font|i|kbd|mark|q|s|small|span|strong|sub|sup|tt|u|var)(?:\s[^>]*)?>"
)
TAG = r"<[/!?a-zA-Z][^>]*>"
BLANKS = r"[ \t\r\f\x0B]+"
LINES = r" ?\n[ \n]*"
TITLE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"
LINK = r"""(?i)\s(?:href|src)\s*=\s*["']([^"']*)["']"""
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def record_id(kind: str, *parts: Column) -> Column:
    h = F.md5(F.concat_ws("/", F.lit(kind), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    pieces = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def plain_text(html: Column) -> Column:
    """Visible text: comments, scripts, styles and inline tags go, other tags end a line, blanks are
    joined and the common named entities are resolved."""
    text = F.regexp_replace(F.regexp_replace(html, HIDDEN, ""), TAG, "\n")
    for name, sign in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(sign))
    return F.btrim(F.regexp_replace(F.regexp_replace(text, BLANKS, " "), LINES, "\n"), F.lit(" \n"))


def resolved(link: Column, url: Column) -> Column:
    """A link against its page's address; dot segments stay as they are."""
    origin = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    page = F.regexp_extract(url, r"^([^#]*)", 1)
    path = F.regexp_extract(url, r"^([^?#]*)", 1)
    folder = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/(?:[^?#]*/)?)", 1)
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("?"), F.concat(path, link))
        .when(link.startswith("#") | (link == ""), F.concat(page, link))
        .when(folder == "", F.concat(origin, F.lit("/"), link))
        .otherwise(F.concat(folder, link))
    )


def responses(pages: DataFrame, date: str = DATE, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One response record per page: ``page_id, record_type, record_id, target_uri, warc_date,
    content_type, http_headers, payload, payload_digest``. A null address or page counts as empty."""
    rows = reading(pages, page_id=page_id, url=url, html=html)
    url, payload = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    rows = rows.select("page_id", url.alias("target_uri"), payload.alias("payload"))
    size = F.octet_length("payload").cast("string")
    return rows.select(
        "page_id",
        F.lit("response").alias("record_type"),
        record_id("response", F.col("page_id"), F.col("target_uri")).alias("record_id"),
        "target_uri",
        F.lit(date).alias("warc_date"),
        F.lit("application/http; msgtype=response").alias("content_type"),
        F.concat(F.lit(f"Content-Type: {HTML_TYPE}{CRLF}Content-Length: "), size).alias("http_headers"),
        "payload",
        digest(F.col("payload")).alias("payload_digest"),
    )


def derivatives(found: DataFrame) -> DataFrame:
    """The metadata and the conversion record of every response (other record types are left out):
    ``page_id, record_type, record_id, refers_to, concurrent_to, target_uri, warc_date, content_type,
    content_length, block_digest, source_digest, block``. Repeated responses give repeated records;
    ids differ by page and address only."""
    rows = found.filter("record_type = 'response'").select(
        "*",
        record_id("metadata", F.col("record_id")).alias("metadata_id"),
        record_id("conversion", F.col("record_id")).alias("conversion_id"),
        F.regexp_extract_all("payload", F.lit(LINK), F.lit(1)).alias("links"),
        plain_text(F.regexp_extract("payload", TITLE, 1)).alias("title"),
        plain_text(F.col("payload")).alias("text"),
    )
    source = F.concat_ws(
        CRLF,
        F.concat(F.lit("source-type: "), F.col("content_type")),
        F.transform(F.split("http_headers", CRLF), lambda x: F.concat(F.lit("source-header: "), x)),
        F.concat(F.lit("source-payload-digest: "), F.col("payload_digest")),
        F.concat(F.lit("title: "), F.regexp_replace("title", r"\n", " ")),
        F.transform("links", lambda x: F.concat(F.lit("outlink: "), resolved(x, F.col("target_uri")))),
    )

    def record(kind: str, own: str, other: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("record_type"),
            F.col(own).alias("record_id"),
            F.col(other).alias("concurrent_to"),
            F.lit(content_type).alias("type"),
            block.alias("block"),
        )

    both = F.array(
        record("metadata", "metadata_id", "conversion_id", "application/warc-fields", source),
        record("conversion", "conversion_id", "metadata_id", "text/plain", F.col("text")),
    )
    rows = rows.select("page_id", "record_id", "target_uri", "warc_date", "payload_digest", F.explode(both).alias("made"))
    return rows.select(
        "page_id",
        "made.record_type",
        "made.record_id",
        F.col("record_id").alias("refers_to"),
        "made.concurrent_to",
        "target_uri",
        "warc_date",
        F.col("made.type").alias("content_type"),
        F.octet_length("made.block").cast("long").alias("content_length"),
        digest(F.col("made.block")).alias("block_digest"),
        F.col("payload_digest").alias("source_digest"),
        "made.block",
    )


def response_text(found: DataFrame) -> DataFrame:
    """The text of each response record as it stands in a WARC file, in column ``value``."""
    block = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}"), F.col("http_headers"), F.lit(CRLF * 2), F.col("payload"))
    named = {"WARC-Payload-Digest": F.col("payload_digest"), "WARC-Block-Digest": digest(block)}
    return found.select(_framed(named, block).alias("value"))


def derivative_text(made: DataFrame) -> DataFrame:
    """The text of each derivative record as it stands in a WARC file, in column ``value``."""
    named = {
        "WARC-Refers-To": F.col("refers_to"),
        "WARC-Concurrent-To": F.col("concurrent_to"),
        "WARC-Block-Digest": F.col("block_digest"),
    }
    return made.select(_framed(named, F.col("block")).alias("value"))


def _framed(named: dict[str, Column], block: Column) -> Column:
    shared = {
        "WARC-Type": F.col("record_type"),
        "WARC-Record-ID": F.col("record_id"),
        "WARC-Date": F.col("warc_date"),
        "WARC-Target-URI": F.col("target_uri"),
        "Content-Type": F.col("content_type"),
    }
    length = {"Content-Length": F.octet_length(block).cast("string")}
    head = [F.concat(F.lit(f"{k}: "), v) for k, v in (shared | named | length).items()]
    return F.concat(F.concat_ws(CRLF, F.lit(VERSION), *head), F.lit(CRLF * 2), block, F.lit(CRLF))


def write_warc(text: DataFrame, path: str) -> None:
    """Write record texts as gzipped WARC files, one per partition; the line separator is the second
    of the two line ends that close a record."""
    text.write.option("lineSep", CRLF).option("compression", "gzip").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of WARC files with text payloads, one row each: ``record_type, record_id, refers_to,
    target_uri, warc_date, content_type, http_headers, payload, payload_digest, block``.

    Files are read record by record, not whole; a payload that itself holds a version line is split
    there. ``http_headers`` and ``payload`` are null for records that are not HTTP responses.
    """
    rows = spark.read.option("lineSep", VERSION + CRLF).text(path).filter("value <> ''")

    def header(name: str) -> Column:
        found = F.regexp_extract("head", rf"(?im)^{name}: *(.*?)\r?$", 1)
        return F.when(found != "", found)

    at = F.instr("value", CRLF * 2)
    rows = rows.select(
        F.expr("left(value, instr(value, '\\r\\n\\r\\n') - 1)").alias("head"),
        F.substring(F.col("value"), at + 4, F.length("value") - at - 3 - 4).alias("block"),
    )
    http = F.col("content_type").startswith("application/http")
    rows = rows.select(
        header("WARC-Type").alias("record_type"),
        header("WARC-Record-ID").alias("record_id"),
        header("WARC-Refers-To").alias("refers_to"),
        F.coalesce(header("WARC-Target-URI"), F.lit("")).alias("target_uri"),
        header("WARC-Date").alias("warc_date"),
        header("Content-Type").alias("content_type"),
        header("WARC-Payload-Digest").alias("payload_digest"),
        "block",
    )
    split = F.instr("block", CRLF * 2)
    head = F.expr("left(block, instr(block, '\\r\\n\\r\\n') - 1)")
    return rows.select(
        "*",
        F.when(http, F.regexp_replace(head, r"^[^\r\n]*\r\n", "")).alias("http_headers"),
        F.when(http, F.substring(F.col("block"), split + 4, F.length("block"))).alias("payload"),
    )
