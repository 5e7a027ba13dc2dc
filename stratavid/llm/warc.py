"""WARC derivatives: metadata and plain-text conversion records linked to the responses they come from."""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratavid.llm.tokens import slices

VERSION = "WARC/1.1"
# What ends a record and begins the next one; blocks hold no carriage return.
SEPARATOR = f"\r\n\r\n{VERSION}\r\n"

RESPONSE = "record_id string, target_uri string, date string, http_headers string, payload string"
RECORD = (
    "source_id string, warc_type string, record_id string, refers_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, source_headers string, "
    "source_payload_digest string, block string"
)
NAMES = [c.split(" ")[0] for c in RECORD.split(", ")]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(*parts: str) -> str:
    """A record id that the same parts always give."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts))}>"


_DROPPED = re.compile(r"<!--|<(script|style|noscript|template|head)\b", re.I)
_ENDS = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template", "head", "title")}
_TITLE = re.compile(r"<title\b", re.I)
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"""\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HTML = re.compile(r"<html\b", re.I)
_LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z0-9-]+)""", re.I)
_BREAK = re.compile(r"</?(p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|blockquote|pre|hr|title|body)\b[^>]*>", re.I)
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")


def _visible(page: str) -> str:
    """The page without comments and without elements that are not shown, each a space.

    An end mark that is missing once is missing from there on, so it is looked for once.
    """
    out, at, pos, missing = [], 0, 0, set()
    while m := _DROPPED.search(page, pos):
        name = (m[1] or "").lower()
        pos = m.start() + 1
        if name in missing:
            continue
        if name:
            end = _ENDS[name].search(page, m.end())
            stop = end.end() if end else -1
        else:
            stop = page.find("-->", m.end()) + 3 if page.find("-->", m.end()) >= 0 else -1
        if stop < 0:
            missing.add(name)
            continue
        out.append(page[at : m.start()])
        at = pos = stop
    out.append(page[at:])
    return " ".join(out)


def _replaced(tags: re.Pattern, by: str, page: str) -> str:
    """The page with such tags replaced; no tag ends behind the last ``>``."""
    last = page.rfind(">") + 1
    return tags.sub(by, page[:last]) + page[last:]


def plain_text(page: str) -> str:
    """Visible text: one line per block element, white space collapsed, entities resolved."""
    page = " ".join(_visible(page).split())  # line ends of the source are white space
    page = _replaced(_TAG, "", _replaced(_BREAK, "\n", page))
    lines = (" ".join(line.split()) for line in html.unescape(page).replace("\r", "\n").split("\n"))
    return "\n".join(line for line in lines if line)


def _one_line(text: str) -> str:
    return " ".join(html.unescape(_replaced(_TAG, "", text)).split())


def _title(page: str) -> str:
    begin = _TITLE.search(page)
    opened = page.find(">", begin.end()) if begin else -1
    end = _ENDS["title"].search(page, opened + 1) if opened >= 0 else None
    return _one_line(page[opened + 1 : end.start()]) if end else ""


def _language(page: str) -> str:
    """The language of the first html tag that names one."""
    pos = 0
    while m := _HTML.search(page, pos):
        close = page.find(">", m.end())
        lang = _LANG.search(page, m.end(), close if close >= 0 else len(page))
        if lang or close < 0:
            return lang[1].lower() if lang else ""
        pos = close + 1
    return ""


def _links(page: str) -> Iterator[str]:
    """Targets of anchors, in order: the first of each tag. Attributes and ends of tags are looked for once."""
    pos, href, close = 0, _HREF.search(page), -1
    while href and (m := _ANCHOR.search(page, pos)):
        while href and href.start() < m.end():
            href = _HREF.search(page, href.start() + 1)
        if close < m.end():
            close = page.find(">", m.end())
            close = len(page) if close < 0 else close
        pos = m.end()
        if href and href.start() < close:
            yield _one_line(href[1] or href[2] or href[3] or "")
            pos = href.end()


def metadata_block(page: str, headers: str, payload_digest: str) -> str:
    """``application/warc-fields``: what is known of the response, one field a line."""
    fields = [("source-payload-digest", payload_digest), ("title", _title(page)), ("language", _language(page))]
    fields += [("http-" + k.strip().lower(), " ".join(v.split())) for k, _, v in (h.partition(":") for h in headers.splitlines()[1:]) if v.strip()]
    fields += [("outlink", target) for target in _links(page)]
    return "\n".join(f"{k}: {v}" for k, v in fields if v)


def derive(source_id: str, uri: str, date: str, headers: str, payload: str) -> list[tuple]:
    """The metadata and the conversion record of one response, as tuples of RECORD."""
    source = digest(payload.encode())
    meta_id, text_id = record_urn(source_id, "metadata"), record_urn(source_id, "conversion")
    blocks = (
        ("metadata", meta_id, "application/warc-fields", metadata_block(payload, headers, source).replace("\r", " ")),
        ("conversion", text_id, "text/plain; charset=utf-8", plain_text(payload)),
    )
    return [
        (source_id, kind, own, source_id, uri, date, content, len(block.encode()), digest(block.encode()), headers, source, block)
        for kind, own, content, block in blocks
    ]


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records of raw pages (page_id, url, html); the fetch time is an argument.

    The record id follows from page id and url. The page's headers are the least a response has.
    """
    payload = F.coalesce("html", F.lit(""))
    headers = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(payload).cast("string")
    )
    name = F.md5(F.concat_ws("\n", F.lit("response"), F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.coalesce("url", F.lit("-"))))
    dashed = F.concat_ws("-", *(F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    return pages.select(
        F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">")).alias("record_id"),
        F.col("url").alias("target_uri"),
        F.lit(date).alias("date"),
        headers.alias("http_headers"),
        payload.alias("payload"),
    )


def derivatives(sources: DataFrame) -> DataFrame:
    """Two records per response (columns of RECORD): its metadata and its text as a conversion.

    Both refer to the response's id and keep its uri, date and HTTP headers (source_headers) and the
    digest of its payload; their own ids follow from it, so a second run gives the same records.
    One pass without a shuffle.

    Nulls: a missing uri, date or headers is empty, a null payload an empty page. A response without
    an id gets one from its other fields. Repeated responses give repeated records. Empty tables
    give empty results; further columns, whatever their names, are ignored. A page is read in time that
    grows with its length, however many tags in it are left open; a very long one is handled alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "payload"):
                rows = []
                for row in zip(*(part.column(n).to_pylist() for n in range(part.num_columns))):
                    own, uri, date, headers, payload = (v or "" for v in row)
                    rows += derive(own or record_urn(uri, date, headers, payload), uri, date, headers, payload)
                kinds = [pa.int64() if n == "content_length" else pa.string() for n in NAMES]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES)

    columns = [c.split(" ")[0] for c in RESPONSE.split(", ")]
    return sources.select(*(F.col(c).cast("string") for c in columns)).mapInArrow(run, RECORD)


def serialised(records: DataFrame) -> Column:
    """A record as WARC text without its version line and final line ends."""
    header = lambda name, value: F.when(value != "", F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    flat = lambda c: F.regexp_replace(c, "[\r\n]+", " ")
    return F.concat(
        header("WARC-Type", F.col("warc_type")),
        header("WARC-Record-ID", F.col("record_id")),
        header("WARC-Refers-To", F.col("refers_to")),
        header("WARC-Target-URI", flat(F.col("target_uri"))),
        header("WARC-Date", flat(F.col("date"))),
        header("WARC-Block-Digest", F.col("block_digest")),
        header("X-Source-Payload-Digest", F.col("source_payload_digest")),
        header("X-Source-Headers", F.regexp_replace(F.base64(F.encode("source_headers", "UTF-8")), r"\s", "")),
        header("Content-Type", F.col("content_type")),
        F.concat(F.lit("Content-Length: "), F.col("content_length").cast("string"), F.lit("\r\n\r\n")),
        F.col("block"),
    )


def write_warc(records: DataFrame, folder: str) -> None:
    """WARC files, one per task, through Spark's text writer, so any store Spark knows can hold them."""
    text = F.concat(F.lit(f"{VERSION}\r\n"), serialised(records))
    records.select(text.alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of such files, with the columns of RECORD; large files are split at records."""
    lines = spark.read.option("lineSep", SEPARATOR).text(folder)
    # The first record of a file has its version line; the last block is followed by line ends, which
    # blocks themselves do not have.
    whole = F.regexp_replace("value", f"^{VERSION}\r\n", "")
    record = lines.select(F.split(whole, "\r\n\r\n", 2).alias("p")).select(
        F.col("p")[0].alias("head"), F.substring_index(F.col("p")[1], "\r", 1).alias("block")
    )
    field = lambda name: F.regexp_extract("head", f"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    headers = F.unbase64(field("X-Source-Headers"))
    return record.select(
        field("WARC-Refers-To").alias("source_id"),
        field("WARC-Type").alias("warc_type"),
        field("WARC-Record-ID").alias("record_id"),
        field("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("target_uri"),
        field("WARC-Date").alias("date"),
        field("Content-Type").alias("content_type"),
        field("Content-Length").cast("long").alias("content_length"),
        field("WARC-Block-Digest").alias("block_digest"),
        F.decode(headers, "UTF-8").alias("source_headers"),
        field("X-Source-Payload-Digest").alias("source_payload_digest"),
        F.col("block"),
    )
