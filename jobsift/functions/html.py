"""Markup helpers.

Finding elements is done with regular expressions inside the JVM; only turning
markup into visible text needs a parser, which is the one in the standard
library behind an Arrow UDF.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsift.functions.text import strip

# Elements whose text is not shown, elements that never hold text
HIDDEN_ELEMENTS = {"script", "style", "template", "rt", "rp"}
VOID_ELEMENTS = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound",
    "command", "frame", "image", "isindex", "nextid", "spacer",
}

# What must not be looked into while searching for elements
_OPAQUE = r"<!--.*?(?:-->|\z)|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_LD_JSON = (
    r"<script\b(?=[^>]*?\stype\s*=\s*(?:\"application/ld\+json\""
    r"|'application/ld\+json'|application/ld\+json[\s>]))[^>]*>(.*?)</script\s*>"
)
_LINK = r"<a\s+(?:[^>]*?\s)?href\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
_HEADING = r"<h1\b[^>]*>.*?(?:</h1\s*>|\z)"


def elements(html: Column, pattern: str, group: int) -> Column:
    """Matches of ``pattern`` outside comments, scripts and styles; no empties."""
    found = F.regexp_extract_all(html, F.lit(f"(?is){pattern}|{_OPAQUE}"), F.lit(group))
    return F.filter(found, lambda x: x != "")


def link_targets(html: Column) -> Column:
    """``href`` of every link in document order, entities decoded, trimmed."""
    quoted = elements(html, _LINK, 1)
    bare = F.transform(quoted, lambda x: F.regexp_replace(x, "^[\"']|[\"']$", ""))
    return F.transform(decoded(bare), strip)


def ld_json_blocks(html: Column) -> Column:
    """Bodies of the JSON-LD scripts of a page."""
    found = F.regexp_extract_all(html, F.lit(f"(?is)<!--.*?-->|{_LD_JSON}|{_OPAQUE}"), F.lit(1))
    return F.filter(F.transform(found, strip), lambda x: x != "")


def first_heading(html: Column) -> Column:
    """The first ``<h1>`` element with its markup, null without one."""
    found = elements(html, _HEADING, 0)
    return F.get(F.filter(found, lambda x: F.lower(x).startswith("<h1")), F.lit(0))


def decoded(values: Column) -> Column:
    """Entities decoded; only rows that have an ``&`` hand data to Python."""

    @F.arrow_udf("array<string>")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            yield pa.array(
                [None if row is None else [unescape(x) for x in row] for row in lists.to_pylist()],
                pa.list_(pa.string()),
            )

    affected = F.when(F.exists(values, lambda x: F.contains(x, F.lit("&"))), values)
    # marked so that a filter derived from a later explode does not run it again
    return F.coalesce(decode.asNondeterministic()(affected), values)


class _VisibleText(HTMLParser):
    """Collects the strings between tags; a comment also ends a string."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.strings: list[str] = []
        self._current: list[str] = []
        self._open: list[str] = []
        self._hidden = 0

    def _end_string(self) -> None:
        text = "".join(self._current).strip()
        self._current.clear()
        if text and not self._hidden:
            self.strings.append(text)

    def handle_starttag(self, tag, attrs):
        self._end_string()
        if tag not in VOID_ELEMENTS:
            self._open.append(tag)
            self._hidden += tag in HIDDEN_ELEMENTS

    def handle_startendtag(self, tag, attrs):
        self._end_string()

    def handle_endtag(self, tag):
        self._end_string()
        if tag in self._open:
            while True:
                closed = self._open.pop()
                self._hidden -= closed in HIDDEN_ELEMENTS
                if closed == tag:
                    break

    def handle_data(self, data):
        self._current.append(data)

    def handle_comment(self, data):
        self._end_string()

    def handle_decl(self, decl):
        self._end_string()

    def handle_pi(self, data):
        self._end_string()

    def unknown_decl(self, data):
        self._end_string()
        if data.upper().startswith("CDATA["):
            self._current.append(data[6:])
            self._end_string()

    def close(self):
        super().close()
        self._end_string()


def visible_text(markup: str | None, separator: str) -> str | None:
    if markup is None or ("<" not in markup and "&" not in markup):
        return markup and markup.strip()
    parser = _VisibleText()
    parser.feed(markup)
    parser.close()
    return separator.join(parser.strings)


def text_from_html(markup: Column, separator: str = " ") -> Column:
    """Visible text of markup, trimmed strings joined by ``separator``."""

    @F.arrow_udf("string")
    def to_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for values in batches:
            yield pa.array([visible_text(v, separator) for v in values.to_pylist()], pa.string())

    return to_text(markup)
