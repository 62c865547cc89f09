"""Derivative builder for web archives.

Every response record gives two linked records: `metadata`, with the headers that the source
record and its HTTP response carried, and `conversion`, with the plain text of the payload.
Both name the source in WARC-Refers-To and keep its target, date and payload digest; their
own digests are those of their blocks. Record ids are derived from the source id and the
type, so that a lost and repeated task writes the same records again.

Defined cases
* A null or empty payload is a response with an empty body, its conversion an empty text.
* Control characters of a URL, line breaks among them, are percent-encoded in headers.
* A null URL is left out of the headers; rows that repeat a page are records of their own
  with equal ids, since ids are derived from what is archived.
* Records of other types have no derivatives. A block that does not begin with an HTTP
  status line is all payload; bytes that are not in the declared charset are replaced.
* Header order, repeated headers and folded lines survive a round trip.
* Other columns are passed through by ``derive`` if named. Empty tables give no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1"
#: Pages carry no fetch time.
UNDATED = "1970-01-01T00:00:00Z"
_SPACE_NAME = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # names that are URLs
_HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|title)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form"
    r"|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*>", re.I)  # fmt: skip
_TAG = re.compile(r"<[/!?a-zA-Z][^>]*>")
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)

_CONTROL = re.compile(r"[\x00-\x1f\x7f]")

Headers = list[tuple[str, str]]


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE_NAME, json.dumps(parts))}>"


def build(headers: Headers, block: bytes) -> bytes:
    lines = [f"{n}: {v}" for n, v in headers if n.lower() != "content-length"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode()
    return VERSION + b"\r\n" + head + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes) -> Headers:
    found: Headers = []
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and found:  # a folded line
            found[-1] = (found[-1][0], f"{found[-1][1]}\r\n{line}")
        elif ":" in line:
            name, value = line.split(":", 1)
            found.append((name, value.strip()))
    return found


def parse(data: bytes, at: int = 0) -> tuple[Headers, bytes, int]:
    """(headers, block, where the next record begins)."""
    if not data.startswith(b"WARC/", at):
        raise ValueError("not a WARC record")
    end = data.index(b"\r\n\r\n", at)
    headers = _headers(data[data.index(b"\r\n", at) + 2 : end])
    size = int(value_of(headers, "Content-Length") or 0)
    block = data[end + 4 : end + 4 + size]
    return headers, block, end + 4 + size + 4


def value_of(headers: Headers, name: str) -> str | None:
    return next((v for n, v in headers if n.lower() == name.lower()), None)


def split_http(block: bytes) -> tuple[str | None, Headers, bytes]:
    """(status line, headers, payload) of an HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None, [], block
    head, _, payload = block.partition(b"\r\n\r\n")
    status, _, rest = head.partition(b"\r\n")
    return status.decode("utf-8", "replace"), _headers(rest), payload


def plain_text(payload: bytes, content_type: str | None) -> str:
    """The payload's text, a line for each block; markup, scripts and styles are left out."""
    charset = _CHARSET.search(content_type or "")
    try:
        text = payload.decode(charset.group(1) if charset else "utf-8", "replace")
    except LookupError:
        text = payload.decode("utf-8", "replace")
    if "html" in (content_type or "html").lower():
        text = _HIDDEN.sub(" ", text).replace("\n", " ")
        text = html.unescape(_TAG.sub("", _BREAK.sub("\n", text)))
    lines = (" ".join(line.split()) for line in text.split("\n"))
    return "\n".join(line for line in lines if line)


def escaped(url: str) -> str:
    """A URL that stays in its header line: control characters are percent-encoded."""
    return _CONTROL.sub(lambda m: f"%{ord(m.group()):02X}", url)


def response_record(url: str | None, payload: str | None) -> bytes:
    """The response that would have been archived for a page."""
    body = (payload or "").encode("utf-8", "replace")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    block = http.encode() + body
    target = [("WARC-Target-URI", escaped(url))] if url is not None else []
    payload_digest = digest(body)
    return build([
        ("WARC-Type", "response"), *target, ("WARC-Date", UNDATED),
        ("WARC-Record-ID", record_id("response", url or "", payload_digest)),
        ("WARC-Payload-Digest", payload_digest), ("WARC-Block-Digest", digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
    ], block)


def derivatives(record: bytes) -> list[tuple[str, bytes]]:
    """(type, record) of the metadata and conversion records of a response."""
    headers, block, _ = parse(record)
    if value_of(headers, "WARC-Type") != "response":
        return []
    status, http, payload = split_http(block)
    source = value_of(headers, "WARC-Record-ID") or ""
    payload_digest = value_of(headers, "WARC-Payload-Digest") or digest(payload)
    fields = [(f"source-{n}", v) for n, v in headers]
    fields += [("http-status", status)] if status is not None else []
    fields += [(f"http-{n}", v) for n, v in http]
    text = plain_text(payload, value_of(http, "Content-Type")).encode()
    blocks = [
        ("metadata", "application/warc-fields", "".join(f"{n}: {v}\r\n" for n, v in fields).encode()),
        ("conversion", "text/plain; charset=utf-8", text),
    ]
    kept = [(n, v) for n in ("WARC-Target-URI", "WARC-Date") if (v := value_of(headers, n)) is not None]
    return [
        (kind, build([
            ("WARC-Type", kind), *kept, ("WARC-Record-ID", record_id(kind, source)),
            ("WARC-Refers-To", source), ("WARC-Source-Payload-Digest", payload_digest),
            ("WARC-Block-Digest", digest(own)), ("Content-Type", content_type),
        ], own))
        for kind, content_type, own in blocks
    ]


# --- on Spark ------------------------------------------------------------------------


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record) for pages with (page_id, url, html)."""

    @F.pandas_udf("binary")
    def of(urls: pd.Series, pages: pd.Series) -> pd.Series:
        return pd.Series([response_record(u, p) for u, p in zip(urls, pages)], dtype=object)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), of("url", "html").alias("record"))


DERIVED = (
    "type string, record_id string, refers_to string, target_uri string, date string, "
    "content_type string, content_length long, block_digest string, "
    "source_payload_digest string, record binary"
)


def derive(records: DataFrame, key: str = "page_id") -> DataFrame:
    """The derivative records of (key, record), with what their headers say as columns."""

    def of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in DERIVED.split(", ")]
        fields = ["WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Date", "Content-Type",
                  "Content-Length", "WARC-Block-Digest", "WARC-Source-Payload-Digest"]
        for part in parts:
            rows = []
            for own, record in zip(part[key], part["record"]):
                for kind, made in derivatives(record) if record else []:
                    head = dict(parse(made)[0])
                    values = [head.get(f) for f in fields]
                    values[5] = int(values[5])
                    rows.append((own, kind, *values, made))
            yield pd.DataFrame(rows, columns=[key, *names])

    kind = records.schema[key].dataType.simpleString()
    return records.select(key, "record").where(F.col("record").isNotNull()).mapInPandas(
        of, f"{key} {kind}, {DERIVED}"
    )


def archived(records: DataFrame, bytes_per_file: int = 256 << 20) -> DataFrame:
    """(part, warc_gz): the records of each partition as gzip members, in bounded pieces."""

    def packed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size, n = [], 0, 0
        for part in parts:
            for record in part["record"]:
                held.append(gzip.compress(record, mtime=0))
                size += len(held[-1])
                if size >= bytes_per_file:
                    yield pd.DataFrame({"part": [n], "warc_gz": [b"".join(held)]})
                    held, size, n = [], 0, n + 1
        if held:
            yield pd.DataFrame({"part": [n], "warc_gz": [b"".join(held)]})

    return records.select("record").mapInPandas(packed, "part int, warc_gz binary")


def records_in(data: bytes) -> Iterator[bytes]:
    """The records of a WARC file, plain or with a gzip member for each."""
    if data[:2] == b"\x1f\x8b":
        rest = data
        while rest:
            member = zlib.decompressobj(31)
            yield from records_in(member.decompress(rest))
            rest = member.unused_data
        return
    at = 0
    while at < len(data):
        _, _, end = parse(data, at)
        yield data[at:end]
        at = end


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, record) of all WARC files under a path that Spark can read. A file is read by
    one task, as its gzip members have no index."""

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, content in zip(part["path"], part["content"]):
                for record in records_in(content):
                    yield pd.DataFrame({"path": [name], "record": [record]})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(split, "path string, record binary")
