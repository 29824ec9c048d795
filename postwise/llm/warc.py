"""WARC derivatives: metadata and plain-text conversion records of response records.

Input are whole response records (bytes, WARC/1.0 or 1.1). Each gives two linked
records: a metadata record (application/warc-fields: status, media type, charset,
title, language, counts of blocks and links, payload digest) and a conversion
record (text/plain: the page's visible text, one block a line). Both carry
WARC-Refers-To (the response's WARC-Record-ID), its WARC-Target-URI and WARC-Date,
their own WARC-Block-Digest (SHA-1, Base32), and the response's payload digest as
WARC-Refers-To-Payload-Digest. Source headers not set by the builder (such as
WARC-IP-Address or WARC-Warcinfo-ID) are preserved. Record ids are derived from
the response's id and the record type, so a rerun yields the same ids.

Defined results: a record that cannot be parsed, or is no response, gives one row
with type 'error' and the reason; null or empty payloads give an empty conversion;
repeated records give repeated rows. ``record`` holds a whole record, so records
can be written one after the other (gzipped each for .warc.gz).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwise.llm.html import blocks

DATE = "2024-01-01T00:00:00Z"
SET_HERE = {"warc-type", "warc-record-id", "warc-date", "content-type", "content-length", "warc-target-uri",
            "warc-block-digest", "warc-payload-digest", "warc-refers-to", "warc-identified-payload-type", "warc-truncated",
            "warc-concurrent-to"}
TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.I | re.S)
LANG = re.compile(r"<html[^>]*\blang\s*=\s*[\"']?([\w-]+)", re.I)
LINK = re.compile(r"<a\b[^>]*\bhref\s*=", re.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(value: str) -> str:
    """A header value: no line ends."""
    return " ".join(str(value).split())


def build_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.0", *(f"{k}: {one_line(v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers (folded lines joined) and block of one record."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise ValueError("no WARC header")
    headers: list[tuple[str, str]] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and headers:
            headers[-1] = (headers[-1][0], f"{headers[-1][1]} {line.strip()}")
        elif ":" in line:
            k, _, v = line.partition(":")
            headers.append((k.strip(), v.strip()))
    length = dict((k.lower(), v) for k, v in headers).get("content-length", "")
    if not length.isdigit() or int(length) > len(rest):
        raise ValueError("wrong Content-Length")
    return headers, rest[:int(length)]


def record_id(*parts: str) -> str:
    """A urn:uuid that follows from its parts."""
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(parts)).urn}>"


def response_record(page_id: int | None, url: str | None, html: str | None) -> bytes:
    """A response record of a crawled page."""
    payload = (html or "").encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload
    return build_record([("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url or "", digest(payload))),
                         ("WARC-Date", DATE), ("WARC-Target-URI", url or ""),
                         ("WARC-Warcinfo-ID", record_id("warcinfo", "pages")),
                         ("WARC-Payload-Digest", digest(payload)), ("WARC-Block-Digest", digest(block)),
                         ("Content-Type", "application/http; msgtype=response")], block)


def derivatives(record: bytes) -> list[dict]:
    """The metadata and the conversion record of a response record."""
    headers, block = parse_record(record)
    get = {k.lower(): v for k, v in headers}
    if get.get("warc-type") != "response":
        raise ValueError(f"not a response: {get.get('warc-type')}")
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *http = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in http)}
    media, _, params = fields.get("content-type", "").partition(";")
    charset = (re.findall(r"charset\s*=\s*\"?([\w-]+)", params) or ["utf-8"])[0]
    try:
        page = payload.decode(charset, "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    whole = digest(payload)
    found = blocks(page)
    text = "\n".join(b.text for b in found).encode()
    title = TITLE.search(page)
    lang = LANG.search(page)
    notes = [("http-status", (status.split(" ") + [""])[1]), ("media-type", media.strip()), ("charset", charset),
             ("title", one_line(title.group(1)) if title else ""), ("language", lang.group(1) if lang else ""),
             ("blocks", str(len(found))), ("links", str(len(LINK.findall(page)))), ("payload-length", str(len(payload))),
             ("payload-digest", whole), ("payload-digest-valid", str(get.get("warc-payload-digest", whole) == whole).lower())]
    meta = "".join(f"{k}: {v}\r\n" for k, v in notes).encode()
    source = get.get("warc-record-id", "")
    kept = [(k, v) for k, v in headers if k.lower() not in SET_HERE]
    out = []
    for kind, content, data in (("metadata", "application/warc-fields", meta), ("conversion", "text/plain; charset=utf-8", text)):
        own = record_id(kind, source)
        made = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", source),
                ("WARC-Target-URI", get.get("warc-target-uri", "")), ("WARC-Date", get.get("warc-date", "")), *kept,
                ("WARC-Refers-To-Payload-Digest", whole), ("WARC-Block-Digest", digest(data)), ("Content-Type", content)]
        out.append({"type": kind, "record_id": own, "refers_to": source, "target_uri": get.get("warc-target-uri", ""),
                    "date": get.get("warc-date", ""), "content_type": content, "block_digest": digest(data),
                    "payload_digest": whole, "content": data.decode(), "content_length": len(data),
                    "record": build_record(made, data)})
    return out


FIELDS = ["type", "record_id", "refers_to", "target_uri", "date", "content_type", "block_digest", "payload_digest",
          "content", "content_length", "record", "error"]
SCHEMA = ("type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
          "block_digest string, payload_digest string, content string, content_length long, record binary, error string")


def _derived(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 200):
            ids, rows = [], []
            for i, record in zip(b["id"].iloc[at:at + 200], b["record"].iloc[at:at + 200]):
                try:
                    made = derivatives(record or b"")
                except ValueError as e:
                    made = [{"type": "error", "error": str(e)}]
                ids += [i] * len(made)
                rows += made
            out = pd.DataFrame(rows, columns=FIELDS).astype(object)
            out = out.where(out.notna(), None)
            out["content_length"] = out["content_length"].astype("Int64")
            out.insert(0, "id", pd.array(ids, "Int64"))
            yield out


def _responses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 200):
            part = b.iloc[at:at + 200]
            yield pd.DataFrame({"id": part["page_id"].astype("Int64"), "record": [
                response_record(None if pd.isna(i) else int(i), u, h)
                for i, u, h in zip(part["page_id"], part["url"], part["html"])]})


def responses(pages: DataFrame) -> DataFrame:
    """(id, record): a response record of each page."""
    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html") \
        .mapInPandas(_responses, "id long, record binary")


def build_derivatives(records: DataFrame) -> DataFrame:
    """(id, the columns of SCHEMA) of the derivatives of the response records (id, record)."""
    return records.select("id", "record").mapInPandas(_derived, f"id long, {SCHEMA}")
