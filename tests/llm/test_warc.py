from __future__ import annotations

import gzip
import zlib
from html.parser import HTMLParser

import pytest
from conftest import SMALL

from palisade.llm import warc

DATE = "2024-02-01T00:00:00Z"


class Plain(HTMLParser):
    """What a reader sees, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden, self.links = [], 0, []

    def handle_starttag(self, tag, attrs):
        if tag in warc.BREAKING_NAMES:
            self.parts.append("\n<")
        self.hidden += tag in ("head", "script", "style")
        if tag == "body":
            self.hidden = 0
        if tag == "a" and dict(attrs).get("href"):
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        if tag in warc.BREAKING_NAMES:
            self.parts.append("\n<")
        if tag in ("head", "script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data.replace("\n", " "))

    def text(self):
        return "\n".join(line for line in (" ".join(x.split()) for x in "".join(self.parts).split("\n<")) if line)


def derived(spark, rows):
    return warc.derive(spark.createDataFrame(rows, warc.RESPONSE + ", page_id bigint, record string, other string"), DATE).collect()


def test_pages_equal_the_standard_parser(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = warc.derive(warc.responses_of_pages(pages, DATE), DATE).collect()
    html = {r.page_id: r for r in pages.collect()}
    assert len(rows) == 2 * len(html)
    for row in rows:
        source = html[row.page_id]
        parser = Plain()
        parser.feed(source.html)
        parser.close()
        assert row.target_uri == source.url
        assert row.payload_digest == warc.digest(source.html.encode())
        if row.record_type == "conversion":
            assert row.block == parser.text()
        else:
            assert [line[9:] for line in row.block.split("\r\n") if line.startswith("outlink: ")] == [" ".join(x.split()) for x in parser.links]


def test_records_round_trip_through_a_file(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = warc.derive(warc.responses_of_pages(pages, DATE), DATE).collect()
    read = list(warc.records(b"".join(bytes(row.record) for row in rows)))
    assert len(read) == len(rows)
    for row, (headers, block) in zip(rows, read, strict=True):
        assert block.decode() == row.block
        assert headers["WARC-Type"] == row.record_type
        assert headers["WARC-Record-ID"] == row.record_id
        assert headers["WARC-Refers-To"] == row.refers_to
        assert headers["WARC-Payload-Digest"] == row.payload_digest
        assert headers["WARC-Block-Digest"] == row.block_digest == warc.digest(block)
        assert int(headers["Content-Length"]) == row.content_length == len(block)


def test_responses_are_read_from_files(spark, tmp_path):
    blocks = [b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>one</p>", b"HTTP/1.1 404 Gone\r\n\r\n"]
    head = lambda n, kind: [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:{n}>"), ("WARC-Target-URI", f"http://{n}/"), ("WARC-Date", DATE)]
    records = [warc.serialised([*head(n, "response"), ("Content-Length", str(len(b)))], b) for n, b in enumerate(blocks)]
    records.insert(1, warc.serialised([*head(9, "request"), ("Content-Length", "4")], b"GET "))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(records))
    (tmp_path / "b.warc").write_bytes(b"".join(map(gzip.decompress, records)))
    found = warc.read_responses(spark, str(tmp_path)).collect()
    assert sorted((r.record_id, bytes(r.block)) for r in found) == sorted((f"<urn:{n}>", b) for n, b in [*enumerate(blocks)] * 2)


@pytest.mark.parametrize(
    "block, text, status",
    [
        (None, "", None),
        (b"", "", None),
        (b"just text < 5 & more", "just text < 5 & more", None),
        (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>caf\xe9</p>", "caf\xe9", "HTTP/1.1 200 OK"),
        (b"HTTP/1.0 200\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(b"<div>a<br>b</div>"), "a\nb", "HTTP/1.0 200"),
        (b"HTTP/1.0 200\r\nContent-Encoding: deflate\r\n\r\n" + zlib.compress(b"x"), "x", "HTTP/1.0 200"),
        (b"HTTP/1.0 200\r\nContent-Encoding: gzip\r\n\r\nplain", "plain", "HTTP/1.0 200"),
        (b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3\r\nabc\r\n4;x=1\r\ndefg\r\n0\r\n\r\n", "abcdefg", "HTTP/1.1 200 OK"),
        (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=no-such\r\n\r\n\xffok", "�ok", "HTTP/1.1 200 OK"),
        (b"<title>T</title><script>var a = '</p>';</script><!-- <p>no</p> --><p title='a > b'>yes &amp; <b>no</b>w", "yes & now", None),
        (b"<style>p{}</style><svg><text>x</text></svg><p>a\nb</p>" + b"<p>c</p>" * 20_000, "a b" + "\nc" * 20_000, None),
    ],
)
def test_blocks(spark, block, text, status):
    for row in derived(spark, [("<urn:1>", "http://a/", DATE, None, block, 1, "r", "o")]):
        assert (row.source_headers or "").split("\n")[0] == (status or "")
        assert row.other == "o"
        assert row.record_type == "metadata" or row.block == text


def test_missing_fields_repeats_and_given_digest(spark):
    rows = derived(spark, [(None, None, None, "sha1:GIVEN", b"x", 1, "r", None)] * 2)
    assert len(rows) == 4 and {r.payload_digest for r in rows} == {"sha1:GIVEN"} and {r.refers_to for r in rows} == {None}
    assert derived(spark, []) == []


@pytest.mark.parametrize(
    "source, text",
    [
        ("<!DOCTYPE html><html><head><title>T</title><p>Hello <b>you</b>", "Hello you"),
        ("<html><head><title>T</title><meta charset=utf-8><LINK href=x><style>p{}</style><script>1</script><noscript>n</noscript>\n<h1>A</h1>B", "A\nB"),
        ("<head><title>T</title><base href=/><template><p>no</p></template>Just text<br>more", "Just text\nmore"),
        ("<head><title>T</title><!-- <p>no</p> --><svg><text>no</text></svg><em>yes</em>", "yes"),
        ("<head><noframes>no</noframes><title>T</title><a href='/l'>link</a>", "link"),
        ("<head><title>T</title>\n<head>\n<p>twice", "twice"),
        ("<head><title>T</title></head>after", "after"),
        ("<head><title>T</title><body>x<p>y", "x\ny"),
        ("<title>T</title><p>no head", "no head"),
    ],
)
def test_pages_that_leave_out_the_end_of_the_head(source, text):
    page = warc.read_page(source)
    assert (page["text"], page["title"]) == (text, "T")


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<p title=don't>Hello world</p><p>more</p>", "Hello world\nmore"),
        ("<a href=it's>link</a> <b title='x>y'>bold</b> <i alt = \"a>b\" '>z</i>", "link bold z"),
        ("one<!-->two<!--->three<!-- gone -->four<!-- gone --!>five", "onetwothreefourfive"),
        ("<p data==\"x>y\">odd</p>", "odd"),
        ("<p a='>open", ""),
    ],
)
def test_quotes_and_comments_as_browsers_read_them(source, text):
    assert warc.read_page(source)["text"] == text


@pytest.mark.parametrize(
    ("block", "body"),
    [
        (b"HTTP/1.1 200 OK\nA: b\n\n<p>one</p>\r\n\r\n<p>two</p>", b"<p>one</p>\r\n\r\n<p>two</p>"),
        (b"HTTP/1.1 200 OK\r\nA: b\r\n\r\none\n\ntwo", b"one\n\ntwo"),
        (b"HTTP/1.1 204 No\r\nA: b", b""),
    ],
)
def test_the_head_ends_at_the_first_empty_line(block, body):
    assert warc.http_message(block)[2] == body


def test_charset_behind_a_long_head_and_several_codings():
    import gzip

    page = b"<html><!--" + b"x" * 5000 + b"--><meta charset=latin-1><p>caf\xe9"
    assert warc.decoded(page, []).endswith("caf\xe9")
    assert warc.charset([], b"<p>charset=latin-1") == "utf-8"
    assert warc.content([("Content-Encoding", "gzip, gzip")], gzip.compress(gzip.compress(b"in"))) == b"in"
    assert warc.content([("Content-Encoding", "gzip, br")], b"as it is") == b"as it is"


def test_records_that_are_not_wanted_are_not_made():
    row = {"record_id": "a", "target_uri": "u", "date": "d", "payload_digest": None, "block": b"<p>x"}
    made, none = warc._derived(row, "d"), warc._derived(row, "d", False)
    assert all(r["record"] for r in made) and not any(r["record"] for r in none)
    assert [{**r, "record": None} for r in made] == none
