"""Derivative WARC records: metadata and plain text of archived responses, linked to their sources."""

from __future__ import annotations

import base64
import gzip
import hashlib
import html
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE = "record_id string, target_uri string, date string, payload_digest string, block binary"
DERIVED = T.StructType(
    [
        T.StructField(name, T.StringType() if kind == "string" else T.LongType() if kind == "long" else T.BinaryType())
        for name, kind in (
            ("record_type", "string"), ("record_id", "string"), ("refers_to", "string"), ("target_uri", "string"), ("refers_to_date", "string"),
            ("date", "string"), ("content_type", "string"), ("source_headers", "string"), ("payload_digest", "string"), ("block_digest", "string"),
            ("content_length", "long"), ("block", "string"), ("record", "binary"),
        )
    ]
)

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
END = b"\r\n\r\n"

UNSEEN = "script|style|noscript|template|iframe|svg|math|head|title|textarea|select"
BREAKING = (
    "address|article|aside|blockquote|br|caption|center|dd|details|div|dl|dt|fieldset|figcaption|figure|footer|form|h1|h2|h3|h4|h5|h6|header|hr|html|li|"
    "main|nav|ol|option|p|pre|section|summary|table|tbody|td|tfoot|th|thead|tr|ul|body"
)
# One markup construct: a comment, a declaration, or a tag with its name and attributes, quoted values taken whole.
# A quote opens a value only right after "="; "<!-->" and "<!--->" are whole comments.
MARKUP = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
CHARSET = re.compile(rb"charset\s*=\s*[\"']?\s*([a-zA-Z0-9_:.-]+)", re.I)
META_CHARSET = re.compile(rb"<meta\b[^>]*?" + CHARSET.pattern, re.I)
HEAD_END = re.compile(rb"\r?\n\r?\n")
RAW = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style", "noscript", "template", "iframe", "textarea", "title")}
# What may stand in a head. Any other start tag, and any text, begins the body where </head> and <body> are left out.
HEAD_NAMES = frozenset("html|head|title|meta|link|base|basefont|bgsound|script|style|noscript|noframes|template".split("|"))
UNSEEN_NAMES, BREAKING_NAMES = frozenset(UNSEEN.split("|")), frozenset(BREAKING.split("|"))


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def derived_id(source: str | None, kind: str) -> str:
    """The same for the same source and kind, so that a task that runs twice makes the same record."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{source} {kind}')}>"


def responses_of_pages(pages: DataFrame, date: str, key: str = "page_id", url: str = "url", body: str = "html") -> DataFrame:
    """Response records of raw pages, with ``key``: a 200 answer whose identifier follows from key, address and body.
    A NULL body is an empty one."""
    content = F.coalesce(F.col(body), F.lit(""))
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, url)]
    name = F.md5(F.concat_ws("\n", *parts, content))
    dashed = F.regexp_replace(name, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(content).cast("string"), F.lit("\r\n\r\n"))
    return pages.select(
        F.col(key),
        dashed.alias("record_id"),
        F.col(url).alias("target_uri"),
        F.lit(date).alias("date"),
        F.lit(None).cast("string").alias("payload_digest"),
        F.concat(head, content).cast("binary").alias("block"),
    )


def derive(responses: DataFrame, date: str, with_record: bool = True) -> DataFrame:
    """A metadata and a conversion record for every response (columns as in ``RESPONSE``; others are carried along).

    Both name the response in WARC-Refers-To, with its address, date and payload digest, which is computed where the
    response brings none; the metadata holds the response's status line and headers, title, language, character set and
    links. ``record`` is the whole record as a gzip member, NULL if it isn't wanted; members one after the other make a WARC
    file.

    A NULL or empty block gives an empty text. Blocks that aren't HTTP messages count as a body without headers.
    Unknown character sets and invalid bytes are read as UTF-8 with replacement characters. A response without identifier
    keeps its two records, with an empty WARC-Refers-To. Repeated rows give repeated records. Carried columns that are
    called like a column of the result are left out.
    """
    own = [c.strip().split(" ")[0] for c in RESPONSE.split(",")]
    names = {f.name for f in DERIVED.fields}
    carried = [f for f in responses.schema.fields if f.name not in names and f.name not in own]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                rows = [record for row in part.select(own).to_pylist() for record in _derived(row, date, with_record)]
                twice = pa.array([i // 2 for i in range(2 * part.num_rows)])
                columns = [part.column(f.name).take(twice) for f in carried]
                columns += [pa.array([r[f.name] for r in rows], _arrow(f.dataType)) for f in DERIVED.fields]
                yield pa.record_batch(columns, names=[*(f.name for f in carried), *(f.name for f in DERIVED.fields)])

    return responses.select(*[f.name for f in carried], *own).mapInArrow(run, T.StructType([*carried, *DERIVED.fields]))


def _arrow(kind: T.DataType) -> pa.DataType:
    return pa.string() if isinstance(kind, T.StringType) else pa.int64() if isinstance(kind, T.LongType) else pa.binary()


def _derived(row: dict, date: str, with_record: bool = True) -> list[dict]:
    status, headers, body = http_message(row["block"] or b"")
    source_digest = row["payload_digest"] or digest(body)
    page = read_page(decoded(content(headers, body), headers))
    fields = [("status", status), *[(f"header-{name.lower()}", value) for name, value in headers], ("title", page["title"]), ("language", page["language"])]
    fields += [("charset", charset(headers, body)), *[("outlink", link) for link in page["links"]]]
    described = "".join(f"{name}: {_line(value)}\r\n" for name, value in fields if value)
    out = []
    for kind, content_type, block in (("metadata", "application/warc-fields", described), ("conversion", "text/plain", page["text"])):
        data = block.encode("utf-8", "replace")
        record_id = derived_id(row["record_id"], kind)
        head = [
            ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date), ("WARC-Refers-To", row["record_id"]),
            ("WARC-Refers-To-Target-URI", row["target_uri"]), ("WARC-Refers-To-Date", row["date"]), ("WARC-Target-URI", row["target_uri"]),
            ("WARC-Payload-Digest", source_digest), ("WARC-Block-Digest", digest(data)), ("Content-Type", content_type), ("Content-Length", str(len(data))),
        ]
        out.append(
            {
                "record_type": kind,
                "record_id": record_id,
                "refers_to": row["record_id"],
                "target_uri": row["target_uri"],
                "refers_to_date": row["date"],
                "date": date,
                "content_type": content_type,
                "source_headers": "\n".join([status, *[f"{n}: {v}" for n, v in headers]]) if status else None,
                "payload_digest": source_digest,
                "block_digest": digest(data),
                "content_length": len(data),
                "block": data.decode(),
                "record": serialised(head, data) if with_record else None,
            }
        )
    return out


def _line(value: str) -> str:
    return " ".join(value.split())


def serialised(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """A record as one gzip member, the same bytes whenever it is made."""
    head = "".join(f"{name}: {_line(value or '')}\r\n" for name, value in headers)
    return gzip.compress(f"{VERSION}\r\n{head}\r\n".encode("utf-8", "replace") + block + END, 6, mtime=0)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of a WARC file, gzip members or plain."""
    if data[:2] == b"\x1f\x8b":
        while data:
            member = zlib.decompressobj(31)
            plain = member.decompress(data) + member.flush()
            yield from records(plain)
            data = member.unused_data
        return
    at = 0
    while at < len(data):
        end = data.find(END, at)
        if end < 0 or not data[at:].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {name.strip(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        length = int(headers["Content-Length"])
        yield headers, data[end + 4 : end + 4 + length]
        at = end + 4 + length + len(END)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """The response records of WARC files; each file is read by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("WARC-Record-ID", "WARC-Target-URI", "WARC-Date", "WARC-Payload-Digest")
        for batch in batches:
            for file in batch.column(0):
                for headers, block in records(file.as_py()):
                    if headers.get("WARC-Type") == "response":
                        values = [pa.array([headers.get(n)], pa.string()) for n in names]
                        yield pa.record_batch([*values, pa.array([block], pa.binary())], names=["record_id", "target_uri", "date", "payload_digest", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RESPONSE)


def http_message(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers and body of a response; anything else is all body."""
    if not block.startswith(b"HTTP/"):
        return "", [], block
    end = HEAD_END.search(block)
    head, body = (block[: end.start()], block[end.end() :]) if end else (block, b"")
    status, *lines = head.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    pairs = [(name.strip(), value.strip()) for name, mark, value in (line.partition(":") for line in lines) if mark]
    return status.strip(), pairs, body


def content(headers: list[tuple[str, str]], body: bytes) -> bytes:
    """The body without transfer and content coding; a body that isn't coded as its headers say stays as it is."""
    named = {name.lower(): value.lower() for name, value in headers}
    if "chunked" in named.get("transfer-encoding", ""):
        body = _unchunked(body)
    # Applied in this order, so undone from the last on.
    for coding in reversed([c.strip() for c in named.get("content-encoding", "").split(",") if c.strip()]):
        if coding in ("gzip", "x-gzip", "deflate"):
            try:
                body = zlib.decompressobj(47).decompress(body)
            except zlib.error:
                return body
        elif coding != "identity":
            return body
    return body


def _unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = re.fullmatch(rb"\s*([0-9a-fA-F]{1,12})\s*(;.*)?", body[at:end])
        if not size:
            return body if not parts else b"".join(parts)
        if not (length := int(size[1], 16)):
            break
        parts.append(body[end + 2 : end + 2 + length])
        at = end + 4 + length
    return b"".join(parts)


def charset(headers: list[tuple[str, str]], body: bytes) -> str:
    for name, value in headers:
        if name.lower() == "content-type" and (found := CHARSET.search(value.encode())):
            return found[1].decode().lower()
    found = META_CHARSET.search(body)
    return found[1].decode().lower() if found else "utf-8"


def decoded(body: bytes, headers: list[tuple[str, str]]) -> str:
    try:
        return body.decode(charset(headers, body), "replace")
    except (LookupError, ValueError):
        return body.decode("utf-8", "replace")


def read_page(source: str) -> dict:
    """Visible text, title, language and links of an HTML page.

    Elements that aren't shown are skipped; a head without end tag ends at the first text or start tag that can't stand in
    it; block elements end a line; blanks run together. What isn't markup is text, so
    plain text comes out as it went in but for its blanks.
    """
    parts, links, title, language = [], [], "", ""
    at, hidden = 0, []
    while at < len(source):
        found = MARKUP.search(source, at)
        text = source[at : found.start() if found else len(source)]
        if hidden and hidden[-1] == "head" and (text.strip() or (found and found[2] and not found[1] and found[2].lower() not in HEAD_NAMES)):
            hidden = [name for name in hidden if name != "head"]
        if not hidden:
            parts.append(text)
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        closing, name = found[1] == "/", found[2].lower()
        if name in BREAKING_NAMES and not hidden:
            parts.append("\n<")
        if closing:
            if name in hidden:
                del hidden[hidden.index(name) :]
            continue
        if name in ("a", "html") and found[3]:
            values = {m[1].lower(): next((v for v in m.groups()[1:] if v is not None), "") for m in ATTRIBUTE.finditer(found[3])}
            if name == "html":
                language = language or html.unescape(values.get("lang", ""))
            elif values.get("href"):
                links.append(html.unescape(values["href"]))
        if name == "body":
            hidden.clear()
        if name in RAW:
            end = RAW[name].search(source, at)
            stop = end.start() if end else len(source)
            if name == "title" and not title:
                title = _line(html.unescape(source[at:stop]))
            at = stop
        elif (name in UNSEEN_NAMES or (name == "noframes" and hidden)) and not found[3].rstrip().endswith("/"):
            hidden.append(name)
    # A break is marked so that line ends of the source count as blanks.
    lines = [" ".join(html.unescape(line).split()) for line in "".join(p if p == "\n<" else p.replace("\n", " ") for p in parts).split("\n<")]
    return {"text": "\n".join(line for line in lines if line), "title": title, "language": language, "links": links}
