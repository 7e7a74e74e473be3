"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

Response records are rows of WARC headers and an HTTP block. Each gives a ``metadata`` record
(``application/warc-fields``: status, title, language, charset, links, digests) and a
``conversion`` record (``text/plain``). Both refer to the response's id, keep its target URI,
date and the source headers, and carry block and payload digests.

A null URL, null HTML or an empty page gives records with empty fields. Rows with equal URL and
content have equal ids, as an id is made of them. A null id column stays null.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
_DROP = re.compile(r"<!--|<(script|style|noscript|template)\b", re.I)
_BREAK = re.compile(
    r"</?(?:address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figure|footer|form|h[1-6]|header|hr|html|"
    r"body|head|title|li|main|nav|ol|p|pre|section|table|tbody|thead|tr|ul)\b[^>]*>",
    re.I,
)
_CELL = re.compile(r"</?t[dh]\b[^>]*>", re.I)
_TAG = re.compile(r"</?[a-zA-Z][^>]*>|<![^>]*>")
_TITLE = re.compile(r"<title\b", re.I)
_TITLE_END = re.compile(r"</title", re.I)
# An element, one of its attributes and what counts as its value.
_LANG = (re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=", re.I), re.compile(r"""\s*["']?([A-Za-z-]+)"""))
_CHARSET = (re.compile(r"<meta\b", re.I), re.compile(r"\bcharset\s*=", re.I), re.compile(r"""\s*["']?([A-Za-z0-9_-]+)"""))
_LINK = (re.compile(r"<a\b", re.I), re.compile(r"\bhref\s*=", re.I), re.compile(r"""\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))"""))


def digest(body: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(chr(0).join(parts).encode()).digest())}>"


def _without_hidden(page: str) -> str:
    """The page without comments, scripts and the like; one that is not closed goes to the end."""
    kept, at = [], 0
    while start := _DROP.search(page, at):
        if start[1] is None:
            end = page.find("-->", start.end())
            end = end + 3 if end >= 0 else len(page)
        else:
            body = page.find(">", start.end())
            if body < 0:  # no tag ends behind here: only a comment may follow
                end = page.find("<!--", start.end())
                return "".join(kept) + page[at : end if end >= 0 else len(page)]
            close = re.compile(rf"</{start[1]}\s*>", re.I).search(page, body + 1)
            end = close.end() if close else len(page)
        kept.append(page[at : start.start()])
        at = end
    return "".join(kept) + page[at:]


def _replaced(tags: re.Pattern, by: str, page: str) -> str:
    """No tag ends behind the last ``>``, so none is looked for there."""
    end = page.rfind(">") + 1
    return tags.sub(by, page[:end]) + page[end:]


def plain_text(page: str) -> str:
    """Visible text: a line per block, one space within lines, no blank lines."""
    page = _replaced(_BREAK, "\n", _without_hidden(page))
    page = html.unescape(_replaced(_TAG, "", _replaced(_CELL, " ", page)))
    lines = (" ".join(line.split()) for line in page.split("\n"))
    return "\n".join(line for line in lines if line)


def _title(page: str) -> str:
    start = _TITLE.search(page)
    body = page.find(">", start.end()) + 1 if start else 0
    end = _TITLE_END.search(page, body) if body else None
    return _one_line(html.unescape(_replaced(_TAG, "", page[body : end.start()]))) if end else ""


def _values(page: str, element: re.Pattern, name: re.Pattern, value: re.Pattern) -> Iterator[re.Match]:
    """The first value of an attribute in each element of a kind. What holds none up to the next
    ``>`` is passed over at once."""
    at = 0
    while start := element.search(page, at):
        stop = page.find(">", start.end())
        stop = len(page) if stop < 0 else stop
        place, found = start.end(), None
        while found is None and (named := name.search(page, place, stop)):
            place = named.end()
            found = value.match(page, place)
        if found:
            yield found
        at = found.end() if found else stop


def _one_line(text: str) -> str:
    return " ".join(text.split())


def write_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"{VERSION}\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def read_record(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers and block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = [(name.strip(), value.strip()) for name, _, value in (line.partition(":") for line in lines[1:])]
    length = int(next((v for n, v in headers if n.lower() == "content-length"), len(rest)))
    return headers, rest[:length]


def response_record(url: str | None, page: str | None, date: str) -> bytes:
    """A response record of a fetched page."""
    body = (page or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    block = http.encode() + body
    return write_record(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", record_id("response", url or "", digest(block))),
            ("WARC-Date", date),
            ("WARC-Target-URI", _one_line(url or "")),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Block-Digest", digest(block)),
            ("WARC-Payload-Digest", digest(body)),
        ],
        block,
    )


def derive(record: bytes) -> dict:
    """The two derived records of a response record and the facts they are linked by."""
    headers, block = read_record(record)
    known = {name.lower(): value for name, value in headers}
    http, _, body = block.partition(b"\r\n\r\n")
    http_lines = http.decode("latin-1").split("\r\n")
    page = body.decode("utf-8", "replace")
    source = known.get("warc-record-id", "")
    text = plain_text(page)
    links = [html.unescape(next(g for g in m.groups(default="") if g)) for m in _values(page, *_LINK) if any(m.groups())]
    fields = [
        ("status", (http_lines[0].split(" ") + ["", ""])[1]),
        *(("http-" + n.strip().lower(), v.strip()) for n, _, v in (h.partition(":") for h in http_lines[1:]) if n),
        ("title", _title(page)),
        ("language", next((m[1] for m in _values(page, *_LANG)), "")),
        ("charset", next((m[1].lower() for m in _values(page, *_CHARSET)), "")),
        ("source-block-digest", known.get("warc-block-digest", digest(block))),
        ("source-payload-digest", known.get("warc-payload-digest", digest(body))),
        *(("outlink", _one_line(link)) for link in links),
    ]
    bodies = {
        "metadata": "".join(f"{n}: {v}\r\n" for n, v in fields).encode(),
        "conversion": text.encode(),
    }
    kinds = {"metadata": "application/warc-fields", "conversion": "text/plain; charset=utf-8"}
    out: dict = {"response_id": source, "title": dict(fields)["title"], "n_links": len(links), "text": text}
    for kind, own in bodies.items():
        name = record_id(kind, source)
        out[f"{kind}_id"] = name
        out[f"{kind}_digest"] = digest(own)
        out[kind] = write_record(
            [
                ("WARC-Type", kind),
                ("WARC-Record-ID", name),
                ("WARC-Date", known.get("warc-date", "")),
                ("WARC-Refers-To", source),
                ("WARC-Refers-To-Target-URI", known.get("warc-target-uri", "")),
                ("WARC-Refers-To-Date", known.get("warc-date", "")),
                ("WARC-Target-URI", known.get("warc-target-uri", "")),
                ("Content-Type", kinds[kind]),
                ("WARC-Block-Digest", digest(own)),
                ("WARC-Source-Payload-Digest", known.get("warc-payload-digest", digest(body))),
            ],
            own,
        )
    return out


_TYPES = {"n_links": "long", "metadata": "binary", "conversion": "binary"}
DERIVED = [
    "response_id", "metadata_id", "conversion_id", "metadata_digest", "conversion_digest",
    "title", "n_links", "text", "metadata", "conversion",
]


def derivatives(records: DataFrame, id_col: str, record_col: str = "record") -> DataFrame:
    """``id`` and the derived records of each response record. No shuffle. A null record gives
    a row with the id alone."""
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                rows = [derive(r) if r is not None else {} for r in part.column(1).to_pylist()]
                yield pa.record_batch(
                    [part.column(0), *(pa.array([r.get(n) for r in rows], types[_TYPES.get(n, "string")]) for n in DERIVED)],
                    names=[id_col, *DERIVED],
                )

    schema = ", ".join([f"`{id_col}` {dict(records.dtypes)[id_col]}", *(f"{n} {_TYPES.get(n, 'string')}" for n in DERIVED)])
    return records.select(id_col, record_col).mapInArrow(run, schema)


def responses(pages: DataFrame, id_col: str, url_col: str, page_col: str, date: str) -> DataFrame:
    """``id, record``: a response record of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 200):
                part = batch.slice(begin, 200)
                urls, bodies = part.column(1).to_pylist(), part.column(2).to_pylist()
                made = [response_record(u, b, date) for u, b in zip(urls, bodies, strict=True)]
                yield pa.record_batch([part.column(0), pa.array(made, pa.binary())], names=[id_col, "record"])

    schema = f"`{id_col}` {dict(pages.dtypes)[id_col]}, record binary"
    return pages.select(id_col, url_col, page_col).mapInArrow(run, schema)


def write_files(derived: DataFrame, kind: str, path: str) -> None:
    """Derived records of one kind as WARC files, one per partition, in a shared folder.
    Records end with two line ends, which are the separator of the text writer."""
    body: Column = F.decode(F.col(kind), "UTF-8")
    record = F.substring(body, F.lit(1), F.char_length(body) - F.lit(4))
    derived.filter(F.col(kind).isNotNull()).select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)
