"""WARC derivatives: responses become linked metadata and plain-text conversion records.

`parse_records` and `render_record` read and write WARC/1.1; `derive` turns each response record of a table of records
into itself, a `metadata` record (links, title, language and sizes) and a `conversion` record (plain text). Derivatives
refer to their response, keep its target URI and date, and carry digests of their own and the source's.
"""
from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, small_batches, utf8

_DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title)\b.*?(?:</\1\s*>|\Z)", re.I | re.S)
_BREAKS = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|nav|header|footer|blockquote|pre|main|aside|figure|hr|dd|dt|dl|form|html|head|body)\b[^>]*>", re.I)
_TAGS = re.compile(r"</?[a-zA-Z!?][^>]*(?:>|\Z)")
_SPACES = re.compile(r"[ \t\f\v\r ]+")
_LINES = re.compile(r" *\n[ \n]*")
_HREF = re.compile(r"<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.I | re.S)
_LANG = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([\w-]+)", re.I)


def digest(data: bytes) -> str:
    """A labelled digest: sha1 in base 32."""
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_text(page: str) -> str:
    """Visible text: scripts, styles, comments and tags go, block elements break lines, entities are resolved."""
    text = _TAGS.sub("", _BREAKS.sub("\n", _DROPPED.sub(" ", page)))
    return _LINES.sub("\n", _SPACES.sub(" ", html.unescape(text))).strip()


def record_id(*parts: str) -> str:
    """The same parts give the same identifier in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(parts))}>"


def render_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record; Content-Length follows the block. Line ends inside header values become spaces."""
    lines = [f"{k}: {re.sub(r'[\r\n]+', ' ', v)}" for k, v in headers if k.lower() != "content-length"] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Headers, in order, and block of each record of an uncompressed file; folded header lines are joined."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC record at {at}")
        lines = re.sub(r"\r\n[ \t]+", " ", data[at:end].decode()).split("\r\n")[1:]
        headers = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines)]
        size = next((int(v) for k, v in headers if k.lower() == "content-length"), -1)
        if size < 0 or end + 4 + size > len(data):
            raise ValueError(f"broken record at {at}")
        yield headers, data[end + 4:end + 4 + size]
        at = end + 4 + size
        while data.startswith(b"\r\n", at):
            at += 2


def http_body(block: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """HTTP headers and body of a response block; a block without a header end is all body."""
    head, mark, body = block.partition(b"\r\n\r\n")
    if not mark or not head.startswith(b"HTTP/"):
        return [], block
    return [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])], body


def derivatives(headers: list[tuple[str, str]], block: bytes) -> list[tuple[str, list[tuple[str, str]], bytes]]:
    """The metadata and the conversion record of a response."""
    own = {k.lower(): v for k, v in headers}
    source, uri, date = own.get("warc-record-id", ""), own.get("warc-target-uri", ""), own.get("warc-date", "1970-01-01T00:00:00Z")
    http, body = http_body(block)
    page = body.decode("utf-8", "replace")
    kind = next((v for k, v in http if k.lower() == "content-type"), "")
    title, lang = _TITLE.search(page), _LANG.search(page)
    fields = [("title", _SPACES.sub(" ", html.unescape(title[1])).strip() if title else ""), ("language", lang[1] if lang else ""), ("http-content-type", kind), ("source-payload-digest", own.get("warc-payload-digest") or digest(body)), ("source-block-digest", own.get("warc-block-digest") or digest(block))]
    fields += [("outlink", html.unescape(a or b or c)) for a, b, c in _HREF.findall(page)]
    meta = "".join(f"{k}: {re.sub(r'[\r\n]+', ' ', v)}\r\n" for k, v in fields).encode("utf-8", "replace")
    text = plain_text(page).encode("utf-8", "replace")
    out = []
    for what, media, data in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=UTF-8", text)):
        kept = [(f"X-Source-{k}", v) for k, v in headers if k.lower() not in ("warc-type", "warc-record-id", "warc-target-uri", "warc-date", "content-length", "content-type")]
        h = [("WARC-Type", what), ("WARC-Record-ID", record_id(what, source, uri)), ("WARC-Refers-To", source), ("WARC-Refers-To-Target-URI", uri), ("WARC-Refers-To-Date", date), ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Block-Digest", digest(data)), ("WARC-Payload-Digest", digest(data)), ("Content-Type", media)]
        out.append((what, [*h, *kept], data))
    return out


def response(page_id, url: str, body: bytes, date: str = "1970-01-01T00:00:00Z") -> tuple[list[tuple[str, str]], bytes]:
    """A response record of a page."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body
    return [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url)), ("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(body)), ("Content-Type", "application/http; msgtype=response")], block


_OUT = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("block_digest", pa.string()), ("source_payload_digest", pa.string()), ("block_bytes", pa.int64()), ("record", pa.binary()), ("error", pa.string())])
_DDL = "page_id long, record_type string, record_id string, refers_to string, target_uri string, block_digest string, source_payload_digest string, block_bytes long, record binary, error string"


def derive(records: DataFrame) -> DataFrame:
    """Each row's (page_id, warc: binary file of any number of records) gives its responses and their derivatives.

    Responses pass through byte by byte; other record types are left out. A file that cannot be parsed gives one row
    whose error says why; null or empty files give none. Repeated rows give repeated records with the same identifiers;
    other columns are ignored."""
    small_batches(records.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for page, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    for headers, block in parse_records(data or b""):
                        h = {k.lower(): v for k, v in headers}
                        if h.get("warc-type", "").lower() != "response":
                            continue
                        paid = h.get("warc-payload-digest") or digest(http_body(block)[1])
                        for kind, hs, b in [("response", headers, block), *derivatives(headers, block)]:
                            g = {k.lower(): v for k, v in hs}
                            rows.append((page, kind, g.get("warc-record-id"), g.get("warc-refers-to"), g.get("warc-target-uri"), digest(b), paid, len(b), render_record(hs, b), None))
                except ValueError as e:
                    rows.append((page, None, None, None, None, None, None, None, None, str(e)[:200]))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_OUT)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, _OUT, strict=True)], schema=_OUT)

    return records.select("page_id", "warc").mapInArrow(lean(run), _DDL)


def page_responses(pages: DataFrame) -> DataFrame:
    """A table of response records, as crawlers store them: page_id, warc. Null urls and pages count as empty."""
    small_batches(pages.sparkSession, 256)

    @F.arrow_udf("binary")
    def built(ids: pa.Array, urls: pa.Array, bodies: pa.Array) -> pa.Array:
        return pa.array([render_record(*response(i, u, b)) for i, u, b in zip(ids.to_pylist(), urls.to_pylist(), bodies.to_pylist(), strict=True)], pa.binary())

    return pages.select("page_id", built(F.col("page_id"), F.coalesce("url", F.lit("")), utf8("html")).alias("warc"))
