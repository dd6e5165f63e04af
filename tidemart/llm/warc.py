"""Derivatives of WARC responses: metadata and plain-text conversion records.

Each response record gives one metadata record, with the headers, digests and
outlinks of its source, and one conversion record with its text. Both name the
response as what they refer to, and the metadata record names the conversion as
concurrent with itself.
"""

from __future__ import annotations

import base64
import codecs
import gzip
import hashlib
import html
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import ship

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tidemart:warc")
_HIDDEN = regex.compile(r"<!--.*?(?:-->|$)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|$)", regex.S | regex.I)
_BLOCKS = frozenset(
    "address article aside blockquote br dd div dl dt footer form h1 h2 h3 h4 h5 h6 head header hr li main nav ol p "
    "pre section table title td th tr ul".split()
)
# One attribute: a quoted value may hold ">", and a quote that is never closed is part of an
# unquoted value. A tag always ends, at the latest with the page, so none is scanned twice.
_PAIR = r"""[\s/]*+{open}[^\s/>][^\s/>=]*+{close}(?:\s*+=\s*+(?:"{open}[^"]*{close}"|'{open}[^']*{close}'|{open}[^\s>]*+{close}))?+"""
_ATTRIBUTE = regex.compile(_PAIR.format(open="(", close=")"))
_TAG = regex.compile(r"<([a-zA-Z/!?][^\s/>]*+)((?:" + _PAIR.format(open="(?:", close=")") + r")*+[\s/]*+(?:>|\Z))")

_HEX = regex.compile(rb"[0-9a-fA-F]{1,15}")
_CHARSET = regex.compile(r"""charset\s*=\s*["']?\s*([\w.:-]+)""", regex.I)
_META = regex.compile(r"<meta\b[^>]*charset[^>]*>", regex.I)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record, with its block's digest and length."""
    lines = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        *headers,
        ("WARC-Block-Digest", digest(block)),
        ("Content-Length", str(len(block))),
    ]
    # A header's value is one line.
    head = b"\r\n".join(f"{k}: {' '.join(v.split())}".encode() for k, v in lines)
    return VERSION + b"\r\n" + head + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-cased name, and the block, of a plain or gzipped record."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return headers, rest[: int(headers.get("content-length", len(rest)))]


def _shown(tag: regex.Match) -> str:
    """What a tag leaves of itself; one that the page breaks off is text."""
    if not tag[2].endswith(">"):
        return tag[0]
    return "\n" if tag[1].strip("/").lower() in _BLOCKS else ""


def text_of(page: str) -> str:
    """The visible text of a page: a line for each block, blanks squeezed."""
    shown = _TAG.sub(_shown, _HIDDEN.sub(" ", page))
    lines = (" ".join(line.split()) for line in html.unescape(shown).split("\n"))
    return "\n".join(line for line in lines if line)


def _target(attributes: str) -> str:
    """The first ``href`` among a tag's attributes; empty if there is none."""
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() == "href":
            return html.unescape("".join(values))
    return ""


def links_of(page: str) -> list[str]:
    """Targets of the page's links, in order, each once."""
    tags = _TAG.findall(_HIDDEN.sub(" ", page))
    found = (" ".join(_target(inside).split()) for name, inside in tags if name in ("a", "A") and inside.endswith(">"))
    return list(dict.fromkeys(x for x in found if x))


def _name(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def response(page_id: int | None, url: str | None, page: str | None, date: str = DATE) -> bytes:
    """A response record as a crawler would have written it for a page."""
    payload = (page or "").encode("utf-8", "surrogatepass")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [
        ("WARC-Date", date),
        ("WARC-Target-URI", url or ""),
        ("WARC-Payload-Digest", digest(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return record("response", _name("response", str(page_id), url or ""), headers, head.encode() + payload)


def _whole(payload: bytes) -> bytes:
    """A chunked body in one piece; as it is if it isn't chunked, and to its break if it is cut off."""
    parts, at = [], 0
    while (end := payload.find(b"\r\n", at)) >= 0:
        digits = payload[at:end].partition(b";")[0].strip()
        if not _HEX.fullmatch(digits):
            break
        if not (size := int(digits, 16)):
            return b"".join(parts)
        parts.append(payload[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(parts) if parts else payload


def _inflated(payload: bytes, coding: str) -> bytes:
    """A gzip or deflate body unpacked, as far as it goes; as it is if it isn't packed."""
    kinds = (31,) if "gzip" in coding else (15, -15)
    for kind in kinds:
        parts, rest = [], payload
        try:
            while rest:
                member = zlib.decompressobj(kind)
                parts.append(member.decompress(rest))
                rest = member.unused_data if kind == 31 else b""
        except zlib.error:
            pass
        if any(parts):
            return b"".join(parts)
    # An empty body packed is a few bytes that unpack to none.
    return b"" if kinds == (31,) and payload[:2] == b"\x1f\x8b" else payload


def page_of(http: list[str], payload: bytes) -> str:
    """The page of a response: codings of its headers undone, then the charset.

    Chunked bodies, gzip and deflate are undone; other codings are left. The charset is
    that of the headers, else that of a ``meta`` tag in the first 1,024 bytes, where HTML
    asks for it, else UTF-8.
    """
    values: dict[str, list[str]] = {}
    for line in http:
        name, _, value = line.partition(":")
        values.setdefault(name.strip().lower(), []).append(value.strip())
    for name in ("transfer-encoding", "content-encoding"):
        for coding in reversed(",".join(values.get(name, [])).lower().split(",")):
            if coding.strip() == "chunked":
                payload = _whole(payload)
            elif coding.strip() in ("gzip", "x-gzip", "deflate"):
                payload = _inflated(payload, coding)
    found = _CHARSET.search(" ".join(values.get("content-type", [])))
    if not found and (meta := _META.search(payload[:1024].decode("latin-1"))):
        found = _CHARSET.search(meta[0])
    try:
        if found and codecs.lookup(found[1])._is_text_encoding:
            return payload.decode(found[1], "replace")
    except (LookupError, ValueError):
        pass
    return payload.decode("utf-8", "replace")


def derive(source: bytes) -> list[tuple[str, str, str, bytes]]:
    """``type, record id, text, record`` of the derivatives of one response record."""
    headers, block = parse_record(source)
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *http = head.decode("utf-8", "replace").split("\r\n")
    page = page_of(http, payload)
    origin = headers.get("warc-record-id", "")
    links = [
        ("WARC-Date", headers.get("warc-date", DATE)),
        ("WARC-Target-URI", headers.get("warc-target-uri", "")),
        ("WARC-Refers-To", origin),
        ("WARC-Refers-To-Target-URI", headers.get("warc-target-uri", "")),
        ("WARC-Refers-To-Date", headers.get("warc-date", DATE)),
    ]
    text = text_of(page)
    conversion_id, metadata_id = _name("conversion", origin), _name("metadata", origin)
    fields = [("http-status", status), *[("http-header", h) for h in http if h]]
    for name in ("warc-payload-digest", "warc-block-digest", "content-type"):
        fields.append((f"source-{name}", headers.get(name, "")))
    # Digests are counted again, so that a damaged source shows.
    fields += [("payload-digest", digest(payload)), ("block-digest", digest(block))]
    fields += [("outlink", x) for x in links_of(page)]
    about = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in fields)
    return [
        (
            "metadata",
            metadata_id,
            about,
            record(
                "metadata",
                metadata_id,
                [*links, ("WARC-Concurrent-To", conversion_id), ("Content-Type", "application/warc-fields")],
                about.encode("utf-8", "replace"),
            ),
        ),
        (
            "conversion",
            conversion_id,
            text,
            record(
                "conversion",
                conversion_id,
                [
                    *links,
                    ("WARC-Payload-Digest", digest(text.encode("utf-8", "replace"))),
                    ("Content-Type", "text/plain; charset=utf-8"),
                ],
                text.encode("utf-8", "replace"),
            ),
        ),
    ]


_KIND = (
    "page_id long, type string, record_id string, refers_to string, target_uri string, "
    "source_digest string, text string, record binary"
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.string()] * 6, pa.binary()]
    columns = list(zip(*rows, strict=True)) or [[]] * 8
    names = [part.split()[0] for part in _KIND.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def _derivatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part, rows = batch.slice(at, 200), []
            for page_id, source in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if source is None:
                    continue
                headers, _ = parse_record(source)
                if headers.get("warc-type") != "response":
                    continue
                for kind, name, text, data in derive(source):
                    rows.append(
                        (
                            page_id, kind, name, headers.get("warc-record-id"),
                            headers.get("warc-target-uri"), headers.get("warc-payload-digest"),
                            text.encode("utf-8", "replace").decode(), data,
                        )
                    )
            yield _batch(rows)


def derivatives(responses: DataFrame, id_col: str = "page_id", record_col: str = "record") -> DataFrame:
    """Two rows per response record: its metadata and its conversion record.

    Records of other types and NULL records have no derivatives. Rows are converted
    one by one, so repeated records give repeated derivatives with equal
    identifiers; NULL ids stay NULL; columns besides the two named are ignored; an
    empty table gives no rows. ``record`` is the complete derivative;
    ``gzip.compress`` of each, joined, is a valid ``.warc.gz``.
    """
    ship(responses.sparkSession)
    rows = responses.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(record_col).alias("record"))
    return rows.mapInArrow(_derivatives, _KIND)


def _responses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            rows = zip(*(part.column(i).to_pylist() for i in range(3)), strict=True)
            made = [response(page_id, url, page) for page_id, url, page in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(made, pa.binary())], ["page_id", "record"]
            )


def responses(pages: DataFrame) -> DataFrame:
    """Response records of a table of pages (``page_id, url, html``); NULLs count as empty."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html")
    return rows.mapInArrow(_responses, "page_id long, record binary")
