"""WARC derivatives: from each response a linked metadata record and a plain-text conversion record.

Input are whole WARC/1.1 records as bytes. Of a response, the record and HTTP headers, the payload
and its digests are read; chunked and compressed payloads are undone for the text. Both derived
records point back by WARC-Refers-To and repeat target, date and the source's payload digest; the
metadata record also lists every source header. A derived record's id follows from the
source's id and its kind, so a task that runs twice makes the same records.

Digests are SHA-1 in base32, as usual in WARC files. A stated digest is kept as stated, and it is
compared with the bytes: ``verified`` is true, false, or null where none is stated.

The text's characters are read by a byte order mark, else the charset of the HTTP header, else the one
that the page states in its first 1,024 bytes, else as UTF-8. A quoted attribute value may hold ``>``.

Records of other types, and bytes that are no WARC record, give no derivative. A response that is
neither text nor markup gives a metadata record alone, and so does one whose body cannot be unpacked: an
unknown coding, broken data, or more than ``MOST_BYTES``; the metadata record then says why. A body
that is stated to be packed but does not begin like it is taken as it is. A null record gives nothing, an empty
payload an empty text. Repeated records are derived each, with equal ids. Columns named in
``columns`` are carried along; others are ignored.

Each task reads and writes its own rows one by one; there is no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, slices

SLICE_BYTES = 4 << 20
MOST_BYTES = 1 << 28
"""Of an unpacked body. A few bytes can unpack to more than a task can hold."""
LINE = b"\r\n"

_SILENT = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|template|noscript)\b.*?(?:</\1\s*>|\Z)", re.S | re.I
)
_BREAKING = frozenset(
    "p div br li ul ol h1 h2 h3 h4 h5 h6 tr table section article header footer nav aside main form "
    "blockquote pre dl dt dd figure figcaption body html head hr".split()
)
# A tag ends at the first > outside quotes; with a quote that never ends, at the first > at all.
_TAG = re.compile(
    r"<[!?][^>]*(?:>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*)(?>[^'\">]+|\"[^\"]*\"|'[^']*')*+(?:>|\Z)"
    r"|</?([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|</[^>]*(?:>|\Z)"
)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w.:-]+)", re.I)
_ENCODING = re.compile(r"<\?xml[^>]*?encoding\s*=\s*[\"']([\w.:-]+)", re.I)
_MARKS = ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be"))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, '|'.join(parts))}>"


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [b"WARC/1.1"] + [f"{n}: {v}".encode() for n, v in headers]
    return LINE.join(lines) + LINE * 2 + block + LINE * 2


def _header_lines(raw: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


@dataclass
class Record:
    headers: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for n, v in self.headers if n.lower() == name.lower()), None)


def read_record(data: bytes | None) -> Record | None:
    if not data or not data.startswith(b"WARC/"):
        return None
    head, mark, rest = data.partition(LINE * 2)
    if not mark:
        return None
    record = Record(_header_lines(head.partition(LINE)[2]), rest)
    length = record.get("Content-Length")
    if length and length.isdigit():
        record.block = rest[: int(length)]
    elif rest.endswith(LINE * 2):
        record.block = rest[:-4]
    return record


@dataclass
class Response:
    status: str
    headers: list[tuple[str, str]]
    payload: bytes

    def get(self, name: str) -> str:
        return next((v for n, v in self.headers if n.lower() == name.lower()), "")


def read_response(block: bytes) -> Response:
    head, _, payload = block.partition(LINE * 2)
    first, _, rest = head.partition(LINE)
    return Response(first.decode("utf-8", "replace"), _header_lines(rest), payload)


def _unchunked(data: bytes) -> bytes:
    out, at = [], 0
    while (end := data.find(LINE, at)) >= 0:
        try:
            size = int(data[at:end].split(b";")[0], 16)
        except ValueError:
            return data if not out else b"".join(out)
        if not size:
            break
        out.append(data[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out)


class Undecoded(Exception):
    """A body that cannot be unpacked; says why."""


def _unpacked(data: bytes, bits: int) -> bytes:
    """Deflated data of any number of members, unpacked a part at a time."""
    out, size = [], 0
    while data:
        unpack = zlib.decompressobj(bits)
        while not unpack.eof:
            part = unpack.decompress(data, 1 << 20)
            size += len(part)
            if size > MOST_BYTES:
                raise Undecoded("too large")
            if not part and not unpack.unconsumed_tail and not unpack.eof:
                raise Undecoded("broken")
            out.append(part)
            data = unpack.unconsumed_tail or unpack.unused_data
        if bits < 31 or not data.startswith(b"\x1f\x8b"):
            break  # only gzip has members; what else follows is padding
    return b"".join(out)


def body_of(response: Response) -> bytes:
    """The payload with transfer and content encodings undone."""
    data = response.payload
    if "chunked" in response.get("Transfer-Encoding").lower():
        data = _unchunked(data)
    codings = [c.strip() for c in response.get("Content-Encoding").lower().split(",")]
    for coding in reversed(codings):
        try:
            if coding in ("gzip", "x-gzip"):
                data = _unpacked(data, 31) if data.startswith(b"\x1f\x8b") else data
            elif coding == "deflate":
                try:
                    data = _unpacked(data, 15)
                except zlib.error:
                    data = _unpacked(data, -15)
            elif coding not in ("", "identity"):
                raise Undecoded(f"unknown coding {coding}")
        except zlib.error as error:
            raise Undecoded("broken") from error
    return data


def decoded(body: bytes, kind: str) -> str:
    """The characters of a body of content type ``kind``."""
    for mark, charset in _MARKS:
        if body.startswith(mark):
            return body[len(mark) :].decode(charset, "replace")
    stated = _CHARSET.search(kind)
    if not stated and not re.match(r"text/plain", kind, re.I):
        start = body[:1024].decode("latin-1")
        stated = _ENCODING.search(start) or _CHARSET.search(start)
    try:
        return body.decode(stated[1] if stated else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def plain_text(markup: str) -> str:
    """All visible text; blanks made one, a line for each block."""

    def edge(tag: re.Match) -> str:
        return "\n" if (tag[1] or tag[2] or "").lower() in _BREAKING else ""

    text = re.sub(r"\s+", " ", _SILENT.sub(" ", markup))
    lines = (" ".join(unescape(line).split()) for line in _TAG.sub(edge, text).split("\n"))
    return "\n".join(line for line in lines if line)


def derive(data: bytes | None) -> list[tuple]:
    """(type, id, refers to, target, date, source digest, verified, block, record) of a response."""
    source = read_record(data)
    if source is None or (source.get("WARC-Type") or "").lower() != "response":
        return []
    own = source.get("WARC-Record-ID") or record_id("unnamed", digest(source.block))
    target, date = source.get("WARC-Target-URI") or "", source.get("WARC-Date") or ""
    response = read_response(source.block)
    found = digest(response.payload)
    stated = source.get("WARC-Payload-Digest")
    verified = None if not stated else stated.upper() == found.upper()
    kind = response.get("Content-Type") or "application/octet-stream"

    def record(what: str, content: str, block: bytes) -> tuple:
        name = record_id(own, what)
        headers = [
            ("WARC-Type", what),
            ("WARC-Record-ID", name),
            ("WARC-Refers-To", own),
            ("WARC-Target-URI", target),
            ("WARC-Date", date),
            ("WARC-Refers-To-Payload-Digest", stated or found),
            ("WARC-Block-Digest", digest(block)),
            ("Content-Type", content),
            ("Content-Length", str(len(block))),
        ]
        whole = write_record(headers, block)
        return what, name, own, target, date, stated or found, verified, block.decode(), whole

    fields = [("http-status-line", response.status)]
    fields += [(f"warc-header-{n.lower()}", v) for n, v in source.headers]
    fields += [(f"http-header-{n.lower()}", v) for n, v in response.headers]
    fields += [("payload-digest", found), ("payload-length", str(len(response.payload)))]
    text = None
    if re.match(r"text/|application/(xhtml\+)?xml", kind, re.I):
        try:
            text = decoded(body_of(response), kind)
        except Undecoded as why:
            fields.append(("body-not-decoded", str(why)))
    lines = "".join(f"{n}: {v}\r\n" for n, v in fields)
    out = [record("metadata", "application/warc-fields", lines.encode())]
    if text is not None:
        if not re.match(r"text/plain", kind, re.I):
            text = plain_text(text)
        out.append(record("conversion", "text/plain; charset=utf-8", text.encode(errors="replace")))
    return out


_OUT = (
    "warc_type string, record_id string, refers_to string, target_uri string, warc_date string, "
    "source_digest string, verified boolean, block string, record binary"
)


def derivatives(responses: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows (*columns, warc_type, record_id, refers_to, target_uri, warc_date, source_digest,
    verified, block, record) for rows (*columns, record)."""
    fields = [responses.schema[c] for c in columns]
    names = [f.name for f in fields] + [c.split()[0] for c in _OUT.split(", ")]
    kinds = [pa.string()] * 6 + [pa.bool_(), pa.string(), pa.binary()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "_record"):
            rows, place = [], []
            for k, data in enumerate(part.column("_record").to_pylist()):
                made = derive(data)
                rows += made
                place += [k] * len(made)
            carried = [part.column(f"_c{k}").take(pa.array(place, pa.int64())) for k in range(len(fields))]
            columns_ = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            made = [pa.array(c, t) for c, t in zip(columns_, kinds, strict=True)]
            yield pa.record_batch([*carried, *made], names=names)

    inner = responses.select(
        *[F.col(f"`{f.name}`").alias(f"_c{k}") for k, f in enumerate(fields)],
        F.col("record").alias("_record"),
    )
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    return map_batches(inner, work, kept + _OUT)


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Rows (page_id, record): each page (page_id, url, html) as the response that brought it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "html"):
            rows = []
            for page, url, html in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
                payload = (html or "").encode()
                head = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                        b"Content-Length: %d" % len(payload)]
                block = LINE.join(head) + LINE * 2 + payload
                headers = [
                    ("WARC-Type", "response"),
                    ("WARC-Record-ID", record_id(str(page), url or "", digest(payload))),
                    ("WARC-Target-URI", url or ""),
                    ("WARC-Date", date),
                    ("WARC-Payload-Digest", digest(payload)),
                    ("WARC-Block-Digest", digest(block)),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("Content-Length", str(len(block))),
                ]
                rows.append(write_record(headers, block))
            yield pa.record_batch(
                [part.column("page_id"), pa.array(rows, pa.binary())], names=["page_id", "record"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return map_batches(rows, work, "page_id long, record binary")
