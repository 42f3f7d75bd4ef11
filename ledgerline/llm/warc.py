"""WARC derivatives: each response becomes a metadata and a plain-text conversion record.

Both new records name the response they come from (``WARC-Refers-To``), keep its target,
date, HTTP header block and payload digest, and have an id and a block digest of their own.
Ids follow from the content, so a repeated or resumed run gives the same records. The whole
step is row by row inside the JVM: no shuffle, no Python. Digests are SHA-256 in hex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
RESPONSE = ["record_id", "target_uri", "date", "http_header", "payload"]
#: Content types of the two derived records.
FIELDS, PLAIN = "application/warc-fields", "text/plain"
# Patterns are plain enough to mean the same in Java and RE2, and take time in proportion to the
# page however broken its markup is: a tag ends before the next one begins, and a script, style or
# comment that is never closed hides the rest of the page.
HIDDEN = (
    r"(?is)<script[^<>]*>.*?(?:</script[^<>]*>|\z)|<style[^<>]*>.*?(?:</style[^<>]*>|\z)|<!--.*?(?:-->|\z)"
)
BREAKS = "(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)(?:[ \t\r\n/][^<>]*)?>"
TAG = "</?[a-zA-Z!?][^<>]*>"
BLANKS, LINES = "[ \t\r\f]+", " ?\n[ \n]*"
TITLE = "(?i)<title[^<>]*>([^<]*)"
LINK = "(?i)<a[ \t\r\n][^<>]*href"
#: Character references that are resolved; the ampersand comes last.
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")]


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def urn(*parts: Column) -> Column:
    """Stable ``urn:uuid`` of the parts."""
    h = F.md5(F.concat_ws("\n", *parts))
    pieces = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *pieces))


def _resolved(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def plain_text(html: Column) -> Column:
    """Visible text, one line per block element; blank runs are one blank, empty lines go."""
    text = F.regexp_replace(F.regexp_replace(html, HIDDEN, " "), BREAKS, "\n")
    text = _resolved(F.regexp_replace(text, TAG, ""))
    return F.trim(F.regexp_replace(F.regexp_replace(text, BLANKS, " "), LINES, "\n"), F.lit(" \n"))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of pages (page_id, url, html): ``page_id`` and the columns RESPONSE.

    A NULL html is an empty payload, a NULL url an empty target. Equal pages have equal ids."""
    html = F.coalesce("html", F.lit(""))
    header = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(html).cast("string"), F.lit(CRLF),
    )
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id", urn(F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), url, F.md5(html)).alias("record_id"),
        url.alias("target_uri"), F.lit(date).alias("date"), header.alias("http_header"), html.alias("payload"),
    )


def derive(records: DataFrame) -> DataFrame:
    """Two rows per response: its other columns, then ``warc_type``, ``record_id``,
    ``refers_to``, ``target_uri``, ``date``, ``content_type``, ``source_header``,
    ``source_digest``, ``block``, ``content_length`` (bytes) and ``block_digest``.

    ``records`` has the columns RESPONSE; columns with the names of results are replaced.
    A NULL payload is an empty one. Repeated rows give repeated records; an empty table gives
    none. Payloads of any length are read whole, in time proportional to their length."""
    made = ["warc_type", "refers_to", "content_type", "source_header", "source_digest", "block", "content_length", "block_digest"]
    others = [c for c in records.columns if c not in RESPONSE + made]
    payload = F.coalesce("payload", F.lit(""))
    source = records.select(
        *others, F.col("record_id").alias("refers_to"), "target_uri", "date",
        F.col("http_header").alias("source_header"), payload.alias("payload"), digest(payload).alias("source_digest"),
        plain_text(payload).alias("_text"),
    )
    title = F.trim(F.regexp_replace(_resolved(F.regexp_extract("payload", TITLE, 1)), "[ \t\r\n\f]+", " "))
    fields = F.concat(
        F.lit("title: "), title, F.lit(f"{CRLF}links: "), F.regexp_count("payload", F.lit(LINK)).cast("string"),
        F.lit(f"{CRLF}payload-digest: "), F.col("source_digest"), F.lit(CRLF), F.col("source_header"),
    )
    both = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit(FIELDS).alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit(PLAIN).alias("content_type"), F.col("_text").alias("block")),
    )
    rows = source.select(*others, "refers_to", "target_uri", "date", "source_header", "source_digest", F.explode(both).alias("r"))
    return rows.select(
        *others, "r.warc_type", urn(F.col("r.warc_type"), F.col("refers_to")).alias("record_id"), "refers_to",
        "target_uri", "date", "r.content_type", "source_header", "source_digest", "r.block",
        F.octet_length("r.block").cast("long").alias("content_length"), digest(F.col("r.block")).alias("block_digest"),
    )


def serialized(derived: DataFrame) -> DataFrame:
    """``derived`` with ``record``: the complete WARC/1.1 record (header, block, end) as bytes.

    Both kinds of records carry the digest and, in folded lines, the HTTP header of the
    response that they refer to."""
    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    def uri(c: str) -> Column:
        return F.concat(F.lit("<"), F.col(c), F.lit(">"))

    header = F.rtrim(F.coalesce("source_header", F.lit("")), F.lit(CRLF))
    folded = F.replace(header, F.lit(CRLF), F.lit(f"{CRLF} "))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("warc_type")), line("WARC-Record-ID", uri("record_id")),
        line("WARC-Refers-To", uri("refers_to")), line("WARC-Refers-To-Payload-Digest", F.col("source_digest")),
        line("WARC-Refers-To-HTTP-Header", folded), line("WARC-Target-URI", F.col("target_uri")), line("WARC-Date", F.col("date")),
        line("WARC-Block-Digest", F.col("block_digest")), line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")), F.lit(CRLF),
    )
    return derived.withColumn("record", F.encode(F.concat(head, F.col("block"), F.lit(CRLF + CRLF)), "UTF-8"))
