"""WARC derivatives."""

from __future__ import annotations

import glob
import hashlib
import html
import random
import re
import time

from footfall.llm import warc
from footfall.llm.queries import FETCHED, op2_warc
from footfall.llm.tables import table
from tests.llm.helpers import SF, by_id

PAGE = (
    '<!DOCTYPE html><html lang="en"><head><meta charset="UTF-8"><title>A &amp; B</title>'
    "<style>p{}</style><script>var t='</p>';</script></head><body><!-- x --><h1>Head</h1>"
    '<p>One <b>two</b>&nbsp;three</p><ul><li><a href="/a?x=1&amp;y=2">link</a></li></ul></body></html>'
)


def test_plain_text():
    assert warc.plain_text(PAGE) == "A & B\nHead\nOne two three\nlink"
    assert warc.plain_text("") == "" and warc.plain_text("1 < 2") == "1 < 2"
    assert warc.plain_text("<script>never closed") == ""


def test_links_and_digests():
    record = warc.response_record("http://x.org/", PAGE, FETCHED)
    headers, block = warc.read_record(record)
    source = dict(headers)
    out = warc.derive(record)
    for kind in ("metadata", "conversion"):
        own_headers, own = warc.read_record(out[kind])
        own_headers = dict(own_headers)
        assert own_headers["WARC-Type"] == kind
        assert own_headers["WARC-Refers-To"] == source["WARC-Record-ID"] == out["response_id"]
        assert own_headers["WARC-Target-URI"] == "http://x.org/" and own_headers["WARC-Date"] == FETCHED
        assert own_headers["WARC-Block-Digest"] == warc.digest(own) == out[f"{kind}_digest"]
        assert own_headers["WARC-Source-Payload-Digest"] == source["WARC-Payload-Digest"]
        assert int(own_headers["Content-Length"]) == len(own)
    fields = warc.read_record(out["metadata"])[1].decode()
    for line in ("status: 200", "title: A & B", "language: en", "charset: utf-8", "outlink: /a?x=1&y=2"):
        assert line in fields
    assert f"source-block-digest: {warc.digest(block)}" in fields


def test_query(spark):
    pages = {r.page_id: r for r in table(spark, SF, "pages").collect()}
    got = by_id(op2_warc(spark, SF), "page_id")
    assert sorted(got) == sorted(pages)
    for i, row in got.items():
        text = warc.plain_text(pages[i].html or "")
        assert row["text_sha256"] == hashlib.sha256(text.encode()).hexdigest() and row["n_chars"] == len(text)
        assert row["n_links"] == (pages[i].html or "").count("<a href=")


def test_odd_pages_and_files(spark, tmp_path):
    rows = [(1, None, None, 1), (2, "", "", 1), (None, "http://a\nb", "<p>é</p>", 1), (4, "u", "x" * 20000, 1), (4, "u", "x" * 20000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record int")
    derived = warc.derivatives(warc.responses(pages, "page_id", "url", "html", FETCHED), "page_id")
    got = derived.collect()
    assert len(got) == 5
    assert len({r.response_id for r in got if r.page_id == 4}) == 1
    warc.write_files(derived, "conversion", str(tmp_path / "out"))
    body = b"".join(open(f, "rb").read() for f in glob.glob(str(tmp_path / "out" / "part-*")))
    assert sorted(body.split(b"WARC/1.1\r\n")[1:]) == sorted(bytes(r.conversion).split(b"WARC/1.1\r\n")[1] for r in got)
    nothing = spark.createDataFrame([(1, None)], "page_id long, record binary")
    assert warc.derivatives(nothing, "page_id").collect()[0].text is None
    assert warc.derivatives(nothing.limit(0), "page_id").count() == 0


def test_pages_against_single_patterns():
    """Brute force: one backtracking pattern for each thing that is looked for."""
    drop = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)", re.S | re.I)
    title = re.compile(r"<title\b[^>]*>(.*?)</title", re.S | re.I)
    patterns = [
        (warc._LANG, re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", re.I)),
        (warc._CHARSET, re.compile(r"""<meta\b[^>]*?\bcharset\s*=\s*["']?([A-Za-z0-9_-]+)""", re.I)),
        (warc._LINK, re.compile(r"""<a\b[^>]*?\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)),
    ]
    parts = ["<a ", "<A", "href", "=", '"', "'", ">", "<", "</a>", "x", " ", "\n", "<!--", "-->", "<script", "</SCRIPT >", "</script>", "<style>",
             "</style>", "<title", "</title>", "<html ", "lang=", "<meta ", "charset = ", "utf-8", "<p>", "<td>", "&amp;", "<!x", "/"]
    rnd = random.Random(8)
    for _ in range(6000):
        page = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert warc._without_hidden(page) == drop.sub("", page), page
        for ours, pattern in patterns:
            assert [m.groups() for m in warc._values(page, *ours)] == [m.groups() for m in pattern.finditer(page)], page
        for tags in (warc._BREAK, warc._CELL, warc._TAG):
            assert warc._replaced(tags, " ", page) == tags.sub(" ", page)
        found = title.search(page)
        want = " ".join(html.unescape(warc._TAG.sub("", found[1])).split()) if found else ""
        assert warc._title(page) == want, page


def test_unclosed_tags_take_linear_time():
    n = 80_000
    for page in ("<a " * n, "<a " * n + ">", "<p " * n, "<script " * n, "<title>" * n, "<title " * n, "<html " * n, "<!--" * n, "<" * n, "</" * n + ">"):
        began = time.process_time()
        warc.derive(warc.response_record("http://x", page, "2024-01-01T00:00:00Z"))
        assert time.process_time() - began < 2
