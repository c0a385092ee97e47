"""Metadata and plain-text records derived from WARC responses.

Every response record yields a metadata record (JSON about the envelope, the HTTP headers
and the page: the scheme of WAT files) and a conversion record (the page's text: the
scheme of WET files). Both point at the response through ``WARC-Refers-To`` and repeat
its target, date and payload digest, so the three stay joined in any later shuffle.
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

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import store, table
from tidemark.session import fresh_dir

#: the date of responses whose source has none
NO_DATE = "1970-01-01T00:00:00Z"
#: bytes that a coded body may unfold to; a larger one is an error row, not a shortened text
MAX_BODY = 1 << 28
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc-derivatives")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, chr(0).join(parts))}>"


def format_record(kind: str, rid: str, uri: str, date: str, content_type: str, block: bytes,
                  more: tuple[tuple[str, str], ...] = ()) -> bytes:
    """One WARC/1.1 record: header lines, an empty line, the block, two empty lines."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Target-URI", uri), ("WARC-Date", date), *more,
            ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


class BadRecord(ValueError):
    """A record that does not follow the format."""


class CutRecord(BadRecord):
    """A record that ends too early."""


class Headers(dict):
    """First value by lower-case name; ``repeated`` has all values of names that occur several times."""

    def __init__(self):
        super().__init__()
        self.repeated: dict[str, list[str]] = {}

    def add(self, name: str, value: str) -> None:
        if name in self:
            self.repeated.setdefault(name, [self[name]]).append(value)
        else:
            self[name] = value


def parse_record(data: bytes) -> tuple[Headers, bytes, int]:
    """(headers, block, bytes of the whole record) of the record ``data`` begins with."""
    end = data.find(b"\r\n\r\n")
    if end < 0 and (data.startswith(b"WARC/") or b"WARC/".startswith(data)):
        raise CutRecord("no WARC header")
    if not data.startswith(b"WARC/"):
        raise BadRecord("no WARC header")
    head = Headers()
    for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise BadRecord(f"header line without a colon: {line[:80]!r}")
        head.add(name.strip().lower(), value.strip())
    size = head.get("content-length", "")
    if not size.isdigit():
        raise BadRecord("no Content-Length")
    if end + 4 + int(size) > len(data):
        raise CutRecord("block shorter than Content-Length")
    stop = end + 4 + int(size)
    return head, data[end + 4:stop], stop + 4


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers in order, body) of an HTTP response."""
    top, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return "", [], block
    lines = top.decode("latin-1").split("\r\n")
    pairs = [line.partition(":") for line in lines[1:]]
    return lines[0], [(k.strip(), v.strip()) for k, _, v in pairs], body


_DROP = re.compile(r"<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>", re.S | re.I)
_BLOCK = re.compile(r"</?(?:p|div|br|h[1-6]|li|ul|ol|table|tr|td|th|section|article|nav|header|footer|main|aside|"
                    r"blockquote|pre|title|hr|form|dl|dt|dd|figure)\b[^>]*>", re.I)
_TAG = re.compile(r"<[a-zA-Z/!?][^>]*>")
_HEAD = re.compile(r"<head\b[^>]*>.*?</head\s*>", re.S | re.I)
_TITLE = re.compile(r"<title\b[^>]*>(.*?)</title\s*>", re.S | re.I)
_LINK = re.compile(r"<(a|area|img|link|script|iframe)\b[^>]*?\b(?:href|src)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_LANG = re.compile(r"<html\b[^>]*\blang\s*=\s*[\"']?([\w-]+)", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([\w-]+)", re.I)
_META = re.compile(rb"<meta\b[^>]*?\bcharset\s*=\s*[\"']?([\w-]+)", re.I)
_CHUNK = re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n")
#: media types whose body is text, and those of them that are marked up
_TEXT = re.compile(r"text/|application/(?:[\w.-]+\+)?(?:xml|json)\b|application/(?:javascript|ecmascript)\b")
_MARKUP = re.compile(r"text/html|text/xml|application/(?:[\w.-]+\+)?xml\b")


def _header(http: list[tuple[str, str]], name: str) -> str:
    return next((v for k, v in http if k.lower() == name), "")


def _unchunked(body: bytes) -> bytes:
    """The body without its chunk sizes; a body that is not chunked as it says stays as it is."""
    out, at = [], 0
    while True:
        m = _CHUNK.match(body, at)
        if not m:
            return body
        size = int(m.group(1), 16)
        if size == 0:
            return b"".join(out)
        if m.end() + size > len(body):
            return body
        out.append(body[m.end():m.end() + size])
        at = m.end() + size + 2


def _inflated(body: bytes, bits: int) -> bytes:
    """All members of a compressed body."""
    out, left = [], body
    while left:
        z = zlib.decompressobj(bits)
        room = MAX_BODY - sum(map(len, out))
        out.append(z.decompress(left, room + 1))
        if len(out[-1]) > room:
            raise BadRecord(f"body unfolds to more than {MAX_BODY} bytes")
        if not z.eof:
            raise zlib.error("incomplete body")
        left = z.unused_data.lstrip(b"\0")
    return b"".join(out)


def entity(body: bytes, http: list[tuple[str, str]]) -> tuple[bytes, str | None]:
    """(the body without transfer and content codings, why it could not be decoded or None)."""
    if "chunked" in _header(http, "transfer-encoding").lower():
        body = _unchunked(body)
    for coding in reversed([c.strip().lower() for c in _header(http, "content-encoding").split(",") if c.strip()]):
        try:
            if coding in ("gzip", "x-gzip"):
                body = _inflated(body, 31)
            elif coding == "deflate":
                try:
                    body = _inflated(body, 15)
                except zlib.error:
                    body = _inflated(body, -15)  # some servers leave the envelope out
            elif coding != "identity":
                return body, f"content coding {coding}"
        except zlib.error as e:
            return body, f"{coding}: {e}"
    return body, None


def is_text(body: bytes, http: list[tuple[str, str]]) -> bool:
    """Whether the media type is one of text; without a media type, whether the body holds no zero byte."""
    kind = _header(http, "content-type").lower()
    return bool(_TEXT.match(kind)) if kind else b"\0" not in body


def decode_body(body: bytes, http: list[tuple[str, str]]) -> str:
    """The text of a body: charset of the byte order mark, the media type or a meta element anywhere, else UTF-8."""
    if body.startswith(b"\xef\xbb\xbf"):
        return body[3:].decode("utf-8", "replace")
    m = _CHARSET.search(_header(http, "content-type"))
    charset = m.group(1) if m else (found.group(1).decode("ascii") if (found := _META.search(body)) else "utf-8")
    try:
        return body.decode(charset, "replace")
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace")


def page_text(page: str) -> str:
    """The text of a page: no scripts, styles or comments; block elements end a line; entities resolved."""
    body = _HEAD.sub(" ", _DROP.sub(" ", page))
    plain = html.unescape(_TAG.sub("", _BLOCK.sub("\n", body)))
    lines = (" ".join(line.split()) for line in plain.split("\n"))
    return "\n".join(line for line in lines if line)


def page_facts(page: str) -> dict:
    clean = _DROP.sub(" ", page)
    title = _TITLE.search(clean)
    lang = _LANG.search(clean)
    links = [{"path": f"{t.upper()}@/{'href' if t.lower() in ('a', 'area', 'link') else 'src'}", "url": html.unescape(a or b or c)}
             for t, a, b, c in _LINK.findall(clean)]
    return {"title": " ".join(html.unescape(title.group(1)).split()) if title else None,
            "lang": lang.group(1) if lang else None, "links": links}


def derive(record: bytes) -> tuple[bytes, bytes | None] | None:
    """(metadata record, conversion record) of a response record; None for other record types.

    Digests are of the body as it was received; the text is of the decoded one. A body
    that is no text, or whose coding cannot be undone, has no conversion record.
    """
    head, block, _ = parse_record(record)
    if head.get("warc-type") != "response":
        return None
    source, uri, date = head["warc-record-id"], head.get("warc-target-uri", ""), head.get("warc-date", NO_DATE)
    status, http, body = parse_http(block)
    payload = head.get("warc-payload-digest") or digest(body)
    plain, problem = entity(body, http)
    text = decode_body(plain, http) if problem is None and is_text(plain, http) else None
    kind = _header(http, "content-type").lower()
    markup = bool(_MARKUP.match(kind)) or not kind
    link = (("WARC-Refers-To", source), ("WARC-Payload-Digest", payload))
    response = {"Status": status, "Headers": [list(x) for x in http], "Entity-Length": len(body), "Entity-Digest": digest(body)}
    if problem:
        response["Entity-Problem"] = problem
    elif len(plain) != len(body):
        response["Decoded-Length"] = len(plain)
    if text is not None and markup:
        response["HTML-Metadata"] = page_facts(text)
    facts = {"Envelope": {"WARC-Header-Metadata": head | head.repeated,
                          "Payload-Metadata": {"HTTP-Response-Metadata": response}}}
    meta = json.dumps(facts, ensure_ascii=False, sort_keys=True).encode()
    conversion = None
    if text is not None:
        conversion = format_record("conversion", record_id("conversion", source), uri, date, "text/plain; charset=utf-8",
                                   (page_text(text) if markup else text).encode(), link)
    return format_record("metadata", record_id("metadata", source), uri, date, "application/json", meta, link), conversion


def response_record(page_id, url: str | None, body: str | None, date: str = NO_DATE) -> bytes:
    """A page as a response record; a null url or body is an empty one."""
    data, uri = (body or "").encode(), url or ""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n").encode() + data
    payload = digest(data)
    return format_record("response", record_id("response", str(page_id), uri, payload), uri, date,
                         "application/http; msgtype=response", block, (("WARC-Payload-Digest", payload),))


_OUT = pa.schema([("source_id", pa.string()), ("uri", pa.string()), ("source_digest", pa.string()),
                  ("metadata_id", pa.string()), ("conversion_id", pa.string()), ("metadata_digest", pa.string()),
                  ("conversion_digest", pa.string()), ("metadata", pa.binary()), ("conversion", pa.binary()),
                  ("error", pa.string())])
OUT_DDL = ("source_id string, uri string, source_digest string, metadata_id string, conversion_id string, "
           "metadata_digest string, conversion_digest string, metadata binary, conversion binary, error string")


def _derive_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, held = [], 0
        for value in b.column(0):
            data = value.as_py()
            try:
                made = derive(data or b"")
            except (BadRecord, KeyError) as e:
                rows.append({"error": f"{type(e).__name__}: {e}"})
                continue
            if made is None:
                continue
            meta, text = (parse_record(x)[0] if x is not None else {} for x in made)
            rows.append({"source_id": meta["warc-refers-to"], "uri": meta["warc-target-uri"],
                         "source_digest": meta["warc-payload-digest"], "metadata_id": meta["warc-record-id"],
                         "conversion_id": text.get("warc-record-id"), "metadata_digest": meta["warc-block-digest"],
                         "conversion_digest": text.get("warc-block-digest"), "metadata": made[0], "conversion": made[1]})
            held += len(made[0]) + len(made[1] or b"")
            if held > 8 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=_OUT)
                rows, held = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=_OUT)


def derivatives(records: DataFrame, record_col: str = "record") -> DataFrame:
    """One row per response in ``record_col`` (binary, one WARC record a row): ids, digests and both derived records.

    Bodies are read through chunked transfer and gzip or deflate content codings. A
    response whose body is no text, or is coded otherwise, has a metadata record only. Records of other types give no row. Null, cut or malformed records give a row that
    holds only ``error``. Equal responses give equal rows with equal ids; an empty table
    gives an empty result. Other columns are ignored.
    """
    return records.select(F.col(f"`{record_col}`").alias("record")).mapInArrow(_derive_task, OUT_DDL)


def responses(pages: DataFrame, date: str = NO_DATE) -> DataFrame:
    """``pages`` (page_id, url, html) as (record) rows; null url or html count as empty."""
    schema = pa.schema([("record", pa.binary())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [{"record": response_record(r["page_id"], r["url"], r["html"], date)} for r in b.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return pages.select("page_id", "url", "html").mapInArrow(task, "record binary")


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri.removeprefix("file:")


def write_warc(records: DataFrame, folder: str, column: str = "record", max_bytes: int = 256 << 20) -> DataFrame:
    """Write the records as .warc.gz files (one gzip member a record) of about ``max_bytes``; returns (path, records).

    A file gets its name when it is complete; a repeated task writes the same names.
    """
    schema = pa.schema([("path", pa.string()), ("records", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        at, made, sink, n, size, temp = TaskContext.get(), [], None, 0, 0, ""

        def finish():
            sink.close()
            name = f"{root}/part-{at.partitionId():06d}-{len(made):05d}.warc.gz"
            fs.move(temp, name)
            made.append({"path": name, "records": n})
        for b in batches:
            for value in b.column(0):
                data = value.as_py()
                if data is None:
                    continue
                if sink is None:
                    temp = f"{root}/.{at.partitionId()}-{at.taskAttemptId()}-{len(made)}"
                    sink, n, size = fs.open_output_stream(temp), 0, 0
                member = gzip.compress(data, 6, mtime=0)
                sink.write(member)
                n, size = n + 1, size + len(member)
                if size >= max_bytes:
                    finish()
                    sink = None
        if sink is not None:
            finish()
        yield pa.RecordBatch.from_pylist(made, schema=schema)
    return store(records.select(F.col(f"`{column}`").alias("record")).mapInArrow(task, "path string, records long"), "warc_files")


def read_warc(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """(record) rows of the .warc.gz files listed in ``files`` (path), each read as a stream."""
    schema = pa.schema([("record", pa.binary())])

    def members(source) -> Iterator[bytes]:
        """Records of a stream of gzip members, however the members cut them.

        A malformed record reaches to the next line that begins a record after an empty one.
        """
        held, seen = b"", 0
        with gzip.GzipFile(fileobj=source) as stream:
            while chunk := stream.read(1 << 20):
                held += chunk
                while held:
                    try:
                        size = parse_record(held)[2]
                    except CutRecord:
                        break  # not complete yet
                    except BadRecord:
                        at = held.find(b"\r\n\r\nWARC/", seen)
                        if at < 0:
                            seen = max(0, len(held) - 8)
                            break
                        size = at + 4
                    if size > len(held):
                        break
                    yield held[:size]
                    held, seen = held[size:], 0
        if held.strip():
            yield held  # what is left is malformed; derivatives() reports it

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(folder)
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as source:
                    for r in members(source):
                        rows.append({"record": r})
                        size += len(r)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    parts = max(1, files.count())
    return files.select("path").repartition(parts, "path").mapInArrow(task, "record binary")


def op4_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of ``pages`` as a response in WARC files, and the ids, digests and sizes of its derivatives."""
    folder = fresh_dir(spark, "llm", "warc")
    files = write_warc(responses(table(spark, sf_dir, "pages")), folder)
    out = derivatives(read_warc(spark, folder, files))
    return out.select("source_id", "uri", "source_digest", "metadata_id", "metadata_digest", "conversion_id",
                      "conversion_digest", F.octet_length("metadata").cast("long").alias("metadata_bytes"),
                      F.octet_length("conversion").cast("long").alias("conversion_bytes"), "error")
