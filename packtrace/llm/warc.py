"""Web-archive derivatives: metadata and plain-text records linked to the responses they come from.

Each response record gives a metadata record (JSON about the payload) and, if the payload is
text, a conversion record with its plain text. Both carry WARC-Refers-To with the response's
record id, its target and date, and its payload digest; every digest is sha1 in base 32.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import html as entities
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from packtrace.llm.common import slices

VERSION = "WARC/1.0"
_SLICE = 8 << 20
_KINDS = (
    "warc_type string, record_id string, refers_to string, target_uri string, date string, content_type string, "
    "content_length long, block_digest string, payload_digest string, source_headers string, block binary"
)
_SCHEMA = pa.schema([
    *[(n, pa.string()) for n in ("warc_type", "record_id", "refers_to", "target_uri", "date", "content_type")],
    ("content_length", pa.int64()), *[(n, pa.string()) for n in ("block_digest", "payload_digest", "source_headers")], ("block", pa.binary()),
])


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(*parts: object) -> str:
    """A name-based id: the same record gets the same id at every run."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(0).join(map(str, parts)).encode('utf-8', 'surrogatepass')).digest(), version=3)}>"


# --- reading and writing ----------------------------------------------------------------


_START = re.compile(rb"(?:^|\n)(WARC/[0-9])")


def parse(data: bytes, lost: list[int] | None = None) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) per record of an archive file, plain or gzipped by record or as a whole.

    A place that is no record, or one cut short, is skipped up to the next line that begins a record;
    ``lost`` gets the bytes of each such stretch.
    """
    lost = [] if lost is None else lost
    if data[:2] == b"\x1f\x8b":
        data = _unzip(data, lost)
    f = io.BytesIO(data)
    while True:
        begin = f.tell()
        line = f.readline()
        while line in (b"\r\n", b"\n"):
            begin = f.tell()
            line = f.readline()
        if not line:
            return
        found = _record(f) if line.startswith(b"WARC/") else None
        if found:
            yield found
            continue
        after = _START.search(data, begin + 1)  # within the broken record, so that none behind it goes with it
        end = after.start(1) if after else len(data)
        lost.append(end - begin)
        f.seek(end)


def _record(f: io.BytesIO) -> tuple[dict[str, str], bytes] | None:
    """What follows a version line; None if it is no whole record."""
    headers: dict[str, str] = {}
    last = ""
    while (line := f.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and last:  # a folded header goes on
            headers[last] += " " + text.strip()
        else:
            name, _, value = text.partition(":")
            last = name.strip().lower()
            headers[last] = value.strip()
    size = headers.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", size):
        return None
    block = f.read(int(size))
    return (headers, block) if len(block) == int(size) else None


def _unzip(data: bytes, lost: list[int]) -> bytes:
    """All readable members; what cannot be inflated is skipped up to the next member's mark."""
    out, at = [], 0
    while at < len(data):
        member = zlib.decompressobj(31)
        try:
            part = member.decompress(data[at:] if at else data)
            if not member.eof:
                lost.append(len(data) - at)  # cut short; what came out of it may still hold whole records
            out.append(part)
            at = len(data) - len(member.unused_data) if member.eof else len(data)
        except zlib.error:
            after = data.find(b"\x1f\x8b\x08", at + 1)
            after = len(data) if after < 0 else after
            lost.append(after - at)
            out.append(b"\r\n")
            at = after
    return b"".join(out)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archive files under ``path``. A file is one task; it must fit a row (2 GB).

    A file with parts that are no records has one more row, of type ``unreadable``, whose
    content_length counts the bytes left out.
    """
    files = spark.read.format("binaryFile").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, size, lost = [], 0, []
                for h, block in parse(content.as_py(), lost):
                    rows.append((
                        h.get("warc-type"), h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"),
                        h.get("content-type"), len(block), h.get("warc-block-digest") or digest(block), h.get("warc-payload-digest"),
                        json.dumps(h, ensure_ascii=False), block))
                    size += len(block)
                    if size > _SLICE:
                        yield _batch(rows)
                        rows, size = [], 0
                if lost:
                    rows.append(("unreadable", *[None] * 5, sum(lost), *[None] * 4))
                yield _batch(rows)

    # one file per batch, as a batch of large files would not fit
    return files.mapInArrow(run, _KINDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def header_lines(row: dict) -> str:
    names = (
        ("WARC-Type", "warc_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"), ("WARC-Target-URI", "target_uri"),
        ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"), ("WARC-Payload-Digest", "payload_digest"),
        ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    )
    lines = [VERSION, *[f"{n}: {row[c]}" for n, c in names if row[c] is not None]]
    return "\r\n".join(lines) + "\r\n\r\n"


def to_bytes(row: dict) -> bytes:
    """One record as it stands in an archive file."""
    return header_lines(row).encode() + row["block"] + b"\r\n\r\n"


def write(records: DataFrame, path: str) -> None:
    """Write records whose blocks are UTF-8 text, as all derivatives are, to gzipped archive files."""
    names = ("warc_type", "record_id", "refers_to", "target_uri", "date", "block_digest", "payload_digest", "content_type", "content_length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [header_lines(r) + r["block"].decode() for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])

    text = records.select(*names, "block").mapInArrow(run, "value string")
    # the text writer ends each line, here each record, with what must follow a block
    text.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").mode("overwrite").text(path)


# --- deriving ------------------------------------------------------------------------------

_SILENT = re.compile(r"<!--.*?(?:-->|$)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|$)|<!\[CDATA\[.*?\]\]>", re.S | re.I)
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|article|section|nav|header|footer|aside|title|body|head|html|blockquote|pre|form|td|th|dd|dt)\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>|<[!?][^>]*>")
_TITLE = re.compile(r"<title[^>]*>(.*?)</title", re.S | re.I)
_LINK = re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def plain_text(html: str) -> str:
    """All text of a page, one line per block; scripts, styles and comments are left out."""
    text = _TAG.sub("", _BREAK.sub("\n", _SILENT.sub(" ", html)))
    lines = (" ".join(line.split()) for line in entities.unescape(text).split("\n"))
    return "\n".join([line for line in lines if line])


def split_http(block: bytes) -> tuple[str, list[list[str]], bytes]:
    """Status line, headers in order, payload. A block without an HTTP head is all payload."""
    head, mark, payload = block.partition(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or not mark:
        return "", [], block
    lines = head.decode("utf-8", "replace").split("\r\n")
    return lines[0], [[n.strip(), v.strip()] for n, _, v in (x.partition(":") for x in lines[1:])], payload


def derivatives(response: dict) -> list[dict]:
    """The metadata record of a response and, for a text payload, its conversion record."""
    status, headers, payload = split_http(response["block"] or b"")
    kind = next((v for n, v in headers if n.lower() == "content-type"), response["content_type"] or "")
    source = response["payload_digest"] or digest(payload)
    textual = kind.startswith("text/") or "html" in kind or "xml" in kind
    charset = re.search(r"charset=[\"']?([\w-]+)", kind)
    try:
        body = payload.decode(charset[1] if charset else "utf-8", "replace") if textual else ""
    except LookupError:
        body = payload.decode("utf-8", "replace")
    title = _TITLE.search(body)
    about = {
        "refers_to": response["record_id"], "target_uri": response["target_uri"], "http_status": status, "http_headers": headers,
        "payload_digest": source, "payload_length": len(payload), "title": " ".join(entities.unescape(title[1]).split()) if title else None,
        "links": [entities.unescape("".join(m)) for m in _LINK.findall(body)],
    }
    common = {
        "refers_to": response["record_id"], "target_uri": response["target_uri"], "date": response["date"], "payload_digest": source,
        "source_headers": json.dumps(headers, ensure_ascii=False),
    }
    out = [("metadata", "application/json", json.dumps(about, ensure_ascii=False).encode("utf-8", "replace"))]
    if textual:
        text = body if kind.startswith("text/plain") else plain_text(body)
        out.append(("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "replace")))
    return [
        {**common, "warc_type": t, "record_id": record_id(t, response["record_id"], source), "content_type": c, "content_length": len(b),
         "block_digest": digest(b), "block": b}
        for t, c, b in out
    ]


def derive(records: DataFrame, carry: str | None = None) -> DataFrame:
    """Metadata and conversion records of all response records; records of other types give none.

    ``carry`` names a bigint column, such as the id of the page, to hand on to the derivatives.

    Null ids, targets, dates and headers stay null; a null block counts as empty. Repeated
    responses give repeated derivatives. Each record is derived on its own: nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "block", _SLICE):
            rows = [{**d, **({carry: r[carry]} if carry else {})} for r in batch.to_pylist() for d in derivatives(r)]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    names = [f.name for f in _SCHEMA] + [carry] * bool(carry)
    schema = _SCHEMA.append(pa.field(carry, pa.int64())) if carry else _SCHEMA
    kinds = f"{_KINDS}, `{carry}` long" if carry else _KINDS
    return records.filter(F.col("warc_type") == "response").select(*names).mapInArrow(run, kinds)


def responses(pages: DataFrame, url: str = "url", html: str = "html", id: str = "page_id", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Response records for a table of raw pages, as a crawler would have stored them; null pages are empty.

    The record id follows from the page's id, address and payload, so repeated rows share it.
    One more column, ``page_id``, holds the page's id.
    """
    schema = _SCHEMA.append(pa.field("page_id", pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html", _SLICE):
            rows = []
            for key, target, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (text or "").encode("utf-8", "surrogatepass")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
                block, of = head.encode() + payload, digest(payload)
                rows.append({
                    "warc_type": "response", "record_id": record_id("response", key, target, of), "target_uri": target, "date": date,
                    "content_type": "application/http; msgtype=response", "content_length": len(block), "block_digest": digest(block),
                    "payload_digest": of, "block": block, "page_id": key})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    rows = pages.select(F.col(id).cast("long").alias("key"), F.col(url).cast("string").alias("target"), F.col(html).cast("string").alias("html"))
    return rows.mapInArrow(run, f"{_KINDS}, page_id long")


def gzip_record(row: dict) -> bytes:
    """One record as a gzip member of its own."""
    return gzip.compress(to_bytes(row), mtime=0)
