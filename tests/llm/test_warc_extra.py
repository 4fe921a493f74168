"""WARC derivatives: malformed transfer codings, an empty table, and text against the standard parser."""
import html.parser
import re
import zlib

import pytest

from martkit.llm import warc_derivatives
from martkit.llm.warc_derivatives import BLOCK, HIDDEN, payload_text, plain_text

from .conftest import SF_SMALL

CHUNKED = {"transfer-encoding": "chunked"}


@pytest.mark.parametrize("body", [
    b"-6\r\nabcdef", b"+3\r\nabc\r\n0\r\n\r\n", b"1_0\r\n" + b"a" * 16 + b"\r\n0\r\n\r\n", b"0x3\r\nabc\r\n0\r\n\r\n", b"\r\nabc",
    b"", b"3", b"abc", b"5\r\nab", b"3\r\nabc", b"3\r\nabcXY0\r\n\r\n", b"ffffffffffffffff\r\nabc\r\n0\r\n\r\n", b"3 4\r\nabc\r\n0\r\n\r\n"])
def test_malformed_chunks_leave_the_body_as_it_is(body):
    assert payload_text(body, CHUNKED) == body.decode()


def test_good_chunks_are_joined():
    assert payload_text(b"3;x=y\r\nabc\r\n0A\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n", CHUNKED) == "abc0123456789"
    packed = zlib.compress(b"plain")
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(packed), packed)
    assert payload_text(chunked, CHUNKED | {"content-encoding": "deflate"}) == "plain"
    assert payload_text(packed[:-3], {"content-encoding": "deflate"}) == packed[:-3].decode("utf-8", "replace")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc_derivatives.derivatives(warc_derivatives.responses_of_pages(pages), "page_id").count() == 0


class Reader(html.parser.HTMLParser):
    """Text outside of hidden elements, a line break at every block tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.depth = [], ""

    def handle_starttag(self, tag, attrs):
        if not self.depth and tag in HIDDEN:
            self.depth = tag
        elif not self.depth and tag in BLOCK:
            self.out.append("\n")

    def handle_startendtag(self, tag, attrs):
        if not self.depth and tag in BLOCK:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if self.depth == tag:
            self.depth = ""
        elif not self.depth and tag in BLOCK:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.depth:
            self.out.append(data)


def test_text_of_all_pages_equals_the_standard_parser(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    for row in rows:
        reader = Reader()
        reader.feed(row["html"])
        reader.close()
        words = re.split(r"\s+", "".join(reader.out).replace("\xa0", " ").strip())
        assert re.split(r"\s+", plain_text(row["html"])) == words, row["page_id"]
