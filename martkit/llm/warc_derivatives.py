"""WARC derivatives: metadata and plain-text conversion records of response records.

Each input row holds one WARC response record as bytes (header lines, HTTP head,
payload). It yields two records that point to it with ``WARC-Refers-To`` (and the
source's URI and date): a ``metadata`` record (``application/warc-fields``) that
keeps every WARC and HTTP header of the source and its digests, and a
``conversion`` record with the page's plain text. A digest that the source names
is kept as it is, a missing one is computed (SHA-1, base 32). Record ids follow
from the source's id, so a rerun writes the same records.

Plain text: chunked and gzip or deflate bodies are decoded, bytes are decoded by
the charset of the Content-Type (else UTF-8, bad bytes replaced); comments,
scripts, styles and templates go, block elements end a line, entities are
resolved, white space is collapsed. One pass over the page, linear in its size.

Defined results: a null record, one without a WARC head or of another type than
``response`` yields no rows. An empty or missing payload yields an empty text.
A payload that does not decode as its headers say is read as it is. Repeated rows
yield repeated records. ``key`` is carried along; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements whose content is not text, and elements that end a line.
HIDDEN = {"script", "style", "template", "noscript", "svg", "iframe", "object"}
BLOCK = set("""address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 head header hr html li main nav ol option p pre section select table tbody td tfoot th thead title
tr ul""".split())
_NAME = re.compile(r"/?([a-zA-Z][a-zA-Z0-9:-]*)")
_BLANK = re.compile(r"[^\S\n]+")
_LINES = re.compile(r" ?\n[ \n]*")

COLUMNS = ("record_type string, record_id string, refers_to string, target_uri string, warc_date string, "
           "content_type string, source_payload_digest string, block_digest string, block string, record binary")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_text(page: str) -> str:
    """Text of an HTML page; one pass over the pieces between ``<`` signs."""
    first, *pieces = page.split("<")
    out, hidden, comment = [first], "", False
    for piece in pieces:
        if comment:
            _, end, rest = piece.partition("-->")
            if end:
                comment = False
                out.append(rest)
            continue
        tag, closed, rest = piece.partition(">")
        name = _NAME.match(tag)
        if hidden:
            if closed and name and tag[0] == "/" and name[1].lower() == hidden:
                hidden = ""
                out.append(rest)
        elif piece.startswith("!--"):
            _, end, rest = piece[3:].partition("-->")
            comment = not end
            out.append(rest)
        elif closed and (name or tag[:1] in ("!", "?")):
            kind = name[1].lower() if name else ""
            if kind in HIDDEN and tag[0] != "/" and not tag.endswith("/"):
                hidden = kind
                continue
            out.append("\n" + rest if kind in BLOCK else rest)
        else:
            out.append("<" + piece)
    text = html.unescape("".join(out)).replace("\xa0", " ")
    return _LINES.sub("\n", _BLANK.sub(" ", text)).strip()


def fields(head: str) -> tuple[str, list[tuple[str, str]]]:
    """First line and (name, value) pairs of a header block; folded lines are joined."""
    first, *lines = head.split("\r\n")
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return first, out


_SIZE = re.compile(rb"[0-9A-Fa-f]{1,15}")


def _unchunk(body: bytes) -> bytes:
    """A chunked body's data; ValueError if a size is no hexadecimal number or a chunk is cut off."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = body[at:end].partition(b";")[0].strip(b" \t")
        if not _SIZE.fullmatch(size):
            raise ValueError("malformed chunk size")
        at = end + 2 + int(size, 16)
        if at == end + 2:
            return b"".join(out)
        if body[at:at + 2] != b"\r\n":
            raise ValueError("chunk cut off")
        out.append(body[end + 2:at])
        at += 2


def payload_text(body: bytes, headers: dict[str, str]) -> str:
    """The payload as text, by its transfer and content coding and its charset."""
    data = body
    try:
        if "chunked" in headers.get("transfer-encoding", "").lower():
            data = _unchunk(data)
        coding = headers.get("content-encoding", "").lower()
        if coding in ("gzip", "x-gzip", "deflate"):
            data = zlib.decompress(data, 47 if "gzip" in coding else 15)
    except (ValueError, zlib.error):
        data = body
    charset = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", headers.get("content-type", ""), re.I)
    try:
        return data.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return data.decode("utf-8", "replace")


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC/1.1 record."""
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def derive(record: bytes | None) -> list[tuple]:
    """The metadata and the conversion record (values of ``COLUMNS``) of one response record."""
    head, split, rest = (record or b"").partition(b"\r\n\r\n")
    version, named = fields(head.decode("utf-8", "replace"))
    source = {name.lower(): value for name, value in named}
    if not split or not version.startswith("WARC/") or source.get("warc-type", "").lower() != "response":
        return []
    length = source.get("content-length", "")
    block = rest[:int(length)] if length.isdigit() else rest.removesuffix(b"\r\n\r\n")
    http_head, _, body = block.partition(b"\r\n\r\n")
    status, http = fields(http_head.decode("latin-1"))
    http_named = {name.lower(): value for name, value in http}
    payload_digest = source.get("warc-payload-digest") or digest(body)
    block_digest = source.get("warc-block-digest") or digest(block)
    text = plain_text(payload_text(body, http_named))
    kept = [f"source-{name}: {value}" for name, value in named]
    kept += [f"source-status: {status}", *(f"source-http-{name}: {value}" for name, value in http),
             f"source-payload-digest: {payload_digest}", f"source-block-digest: {block_digest}"]
    refers = source.get("warc-record-id")
    uri, date = source.get("warc-target-uri"), source.get("warc-date")
    out = []
    for kind, form, data in (("metadata", "application/warc-fields", "\r\n".join(kept) + "\r\n"),
                             ("conversion", "text/plain; charset=UTF-8", text)):
        own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{refers}#{kind}')}>"
        raw = data.encode("utf-8", "replace")
        own_digest = digest(raw)
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own), ("WARC-Refers-To", refers),
                   ("WARC-Target-URI", uri), ("WARC-Date", date), ("WARC-Refers-To-Target-URI", uri),
                   ("WARC-Refers-To-Date", date), ("WARC-Block-Digest", own_digest), ("Content-Type", form)]
        out.append((kind, own, refers, uri, date, form, payload_digest, own_digest, data,
                    serialize([(n, v) for n, v in headers if v], raw)))
    return out


def derivatives(responses: DataFrame, key: str, record: str = "record") -> DataFrame:
    """``key`` and the columns of ``COLUMNS``, two rows per response record."""
    names = [key, *(c.split()[0] for c in COLUMNS.split(", "))]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, *made) for k, r in zip(batch["key"], batch["record"], strict=True)
                    for made in derive(None if r is None else bytes(r))]
            yield pd.DataFrame(rows, columns=names)

    kind = responses.schema[key].dataType.simpleString()
    return responses.select(F.col(key).alias("key"), F.col(record).alias("record")).mapInPandas(
        build, f"`{key}` {kind}, {COLUMNS}")


def _uuid(value: Column) -> Column:
    """``<urn:uuid:...>`` from the first 32 hexadecimal digits of a SHA-256."""
    hexed = F.sha2(value, 256)
    parts = [F.substring(hexed, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def responses_of_pages(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """(page_id, record): each row of ``pages`` (page_id, url, html) as a WARC response record."""
    payload = F.coalesce("html", F.lit(""))
    block = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                     F.octet_length(payload), F.lit("\r\n\r\n"), payload)
    own = _uuid(F.concat_ws("\n", F.col("page_id").cast("string"), F.col("url"), payload))
    uri = F.coalesce(F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"\s+", "%20"), F.lit("\r\n")),
                     F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: "), own, F.lit("\r\n"), uri,
                    F.lit(f"WARC-Date: {date}\r\nContent-Type: application/http; msgtype=response\r\n"
                          "WARC-Payload-Digest: sha256:"), F.sha2(payload, 256),
                    F.lit("\r\nContent-Length: "), F.octet_length(block), F.lit("\r\n\r\n"))
    return pages.select("page_id", F.concat(head, block, F.lit("\r\n\r\n")).cast("binary").alias("record"))
