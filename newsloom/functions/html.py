"""Page field extraction: one parse per page returning one struct.

The parse is the only per-row Python in the collect and enrich paths; it runs
as an Arrow UDF on the standard-library ``html.parser``
tokenizer. Everything after it (date resolution, whitespace squeeze, source
naming) is built-in Spark expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_FIELDS = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("time_text", T.StringType()),
    T.StructField("meta_date", T.StringType()),
    T.StructField("class_text", T.StringType()),
    T.StructField("og_image", T.StringType()),
    T.StructField("og_site_name", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("blocks", T.StringType()),
])

# Fixed values matching the reference extraction rules.
# Class names that mark a date element (case-insensitive substring match).
DATE_CLASS = re.compile(r"date|time|datetime|published|the-date|cal", re.I)
# <meta property=...> values that carry the article date.
DATE_META_PROPERTIES = ("article:modified_time", "date")
# Elements whose strings are not page text (scripts, styles, templates, ruby annotations).
HIDDEN_TEXT_TAGS = frozenset({"script", "style", "template", "rt", "rp"})
# HTML void elements: they never contain text.
VOID_TAGS = frozenset({
    "area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
    "menuitem", "meta", "param", "source", "track", "wbr", "basefont", "bgsound",
    "command", "frame", "image", "isindex", "nextid", "spacer",
})


# Elements that separate words of the analysed text: everything but the
# inline elements of running text.
INLINE_TAGS = frozenset({
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "mark", "q", "rb", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "tt",
    "u", "var", "wbr",
})


# Most tags are plain: a name and no more. Elements whose content the tokenizer
# reads in another way are left to it.
_PLAIN_START = re.compile("<([a-zA-Z][a-zA-Z0-9]*)>")
_PLAIN_END = re.compile("</([a-zA-Z][a-zA-Z0-9]*)>")
_RAW_TAGS = frozenset({
    "script", "style", "title", "textarea", "plaintext", "xmp", "iframe", "noembed", "noframes", "noscript",
})


class _Collector:
    """Text of one element: the page's text parts from ``start`` up to
    ``stop`` (None while the element is open)."""
    __slots__ = ("start", "stop")

    def __init__(self, start: int):
        self.start = start
        self.stop: int | None = None


class PageParser(HTMLParser):
    """Single pass over a page collecting every field the pipeline needs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, list[_Collector]]] = []
        self.open_tags: dict[str, int] = {}
        self.block_parts: list[str] = []
        self.hidden = 0
        self.text_parts: list[str] = []
        self.title: _Collector | None = None
        self.time: _Collector | None = None
        self.meta_date: str | None = None
        self.meta_date_seen = False
        self.og: dict[str, str | None] = {}
        self.open_cands: list[_Collector] = []   # open class candidates, start order
        self.winner: _Collector | None = None

    # -- tokenizer: plain tags in one step, no line numbers -------------
    def updatepos(self, i, j):
        return j

    def parse_starttag(self, i):
        m = _PLAIN_START.match(self.rawdata, i)
        tag = m.group(1).lower() if m else None
        if tag is None or tag in _RAW_TAGS:
            return super().parse_starttag(i)
        self.handle_starttag(tag, ())
        return m.end()

    def parse_endtag(self, i):
        m = _PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if m is None:
            return super().parse_endtag(i)
        self.handle_endtag(m.group(1).lower())
        return m.end()

    # -- tokens --------------------------------------------------------
    def handle_starttag(self, tag, attrs):
        a = {k: ("" if v is None else v) for k, v in attrs} if attrs else {}
        self._break(tag)
        if tag == "meta":
            self._meta(a)
        opened: list[_Collector] = []
        if tag == "time" and self.time is None:
            self.time = _Collector(len(self.text_parts))
            opened.append(self.time)
        if tag == "title" and self.title is None:
            self.title = _Collector(len(self.text_parts))
            opened.append(self.title)
        if a and self.winner is None and DATE_CLASS.search(a.get("class", "")):
            c = _Collector(len(self.text_parts))
            self.open_cands.append(c)
            opened.append(c)
        if tag in VOID_TAGS:
            for c in opened:
                self._close(c)
            return
        self.stack.append((tag, opened))
        self.open_tags[tag] = self.open_tags.get(tag, 0) + 1
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._break(tag)
        if not self.open_tags.get(tag):
            return  # an end tag without its start closes nothing
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    self._pop()
                return

    def handle_data(self, data):
        self._text(data)

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            self._text(data[6:])

    # comments, doctype and processing instructions are not text
    def handle_comment(self, data):
        pass

    def handle_decl(self, decl):
        pass

    def handle_pi(self, data):
        pass

    # -- state ---------------------------------------------------------
    def _meta(self, a):
        prop = a.get("property")
        if prop is None:
            return
        if not self.meta_date_seen and prop in DATE_META_PROPERTIES:
            self.meta_date_seen = True
            self.meta_date = a.get("content")
        if prop in ("og:image", "og:site_name") and prop not in self.og:
            self.og[prop] = a.get("content") or None

    def _text(self, data):
        if self.hidden:
            return
        self.text_parts.append(data)
        self.block_parts.append(data)
        if self.winner is None and self.open_cands and data.strip():
            self.winner = self.open_cands[0]

    def _break(self, tag):
        if tag not in INLINE_TAGS and self.block_parts and self.block_parts[-1] != "\n":
            self.block_parts.append("\n")

    def _close(self, c: _Collector):
        c.stop = len(self.text_parts)
        if self.open_cands and self.open_cands[-1] is c:
            self.open_cands.pop()

    def _inside(self, c: _Collector | None) -> str | None:
        return "".join(self.text_parts[c.start:c.stop]) if c else None

    def _pop(self):
        tag, opened = self.stack.pop()
        self.open_tags[tag] -= 1
        if tag in HIDDEN_TEXT_TAGS:
            self.hidden -= 1
        for c in opened:
            self._close(c)

    def result(self) -> dict:
        self.close()
        return {
            "title": self._inside(self.title),
            "time_text": self._inside(self.time),
            "meta_date": self.meta_date,
            "class_text": self._inside(self.winner).strip() if self.winner else None,
            "og_image": self.og.get("og:image"),
            "og_site_name": self.og.get("og:site_name"),
            "text": "".join(self.text_parts),
            "blocks": re.sub("\n{2,}", "\n", "".join(self.block_parts)).strip("\n"),
        }


_EMPTY = {f.name: None for f in PAGE_FIELDS.fields}


def parse_html(html: str | None) -> dict:
    """Fields of one page; a missing page or a parser failure gives NULLs."""
    if html is None:
        return dict(_EMPTY)
    try:
        p = PageParser()
        p.feed(html)
        return p.result()
    except Exception:
        return dict(_EMPTY)


#: Pages whose fields a worker holds at once, whatever an Arrow batch has.
PAGES_AT_ONCE = 100
_ARROW_FIELDS = pa.struct([(name, pa.string()) for name in PAGE_FIELDS.fieldNames()])


def parse_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The fields of all pages of all batches, a few pages at a time."""
    for html in batches:
        for at in range(0, len(html), PAGES_AT_ONCE):
            yield pa.array([parse_html(h) for h in html.slice(at, PAGES_AT_ONCE).to_pylist()], _ARROW_FIELDS)


@F.arrow_udf(PAGE_FIELDS)
def _parse_pages(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from parse_batches(batches)


def parse_page(html: Column | str) -> Column:
    """``struct<title, time_text, meta_date, class_text, og_image,
    og_site_name, text>``. Materialise it as one column and read fields in a
    later projection, so each page is parsed once."""
    return _parse_pages(html if isinstance(html, Column) else F.col(html))
