"""Page field extraction on hand-made pages (FIXTURES section 4)."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from newsloom.functions.html import parse_html
from newsloom.functions import text as X
from newsloom.sources import pages as P

REF = dt.date(2026, 12, 1)

CASES = [
    ('<time datetime="2020-01-01">2024-03-05</time>', dt.date(2024, 3, 5), False),
    ('<time><b>2024</b>-03-05</time>', dt.date(2024, 3, 5), False),
    ('<time></time><time>2024-03-05</time><meta property="date" content="2024-01-02">',
     dt.date(2024, 1, 2), False),
    ('<time> </time><meta property="date" content="2024-01-02">', None, False),
    ('<meta property="date" content="2024-01-02"><meta property="article:modified_time" content="2024-01-03">',
     dt.date(2024, 1, 2), False),
    ('<meta property="article:published_time" content="2024-01-02">', None, False),
    ('<meta name="date" content="2024-01-02">', None, False),
    ('<meta property="date"><meta property="date" content="2024-01-09"><p class="date">2024-01-04</p>',
     dt.date(2024, 1, 4), False),
    ('<p class="UpdateBox">2024-01-05</p>', dt.date(2024, 1, 5), False),
    ('<p class="local">hello</p>', None, False),
    ('<i class="date"></i><i class="time">2024-01-06</i>', dt.date(2024, 1, 6), False),
    ('<time>2024-13-45</time>', None, True),
]


def test_fields_pure():
    f = parse_html('<p class="local">hello</p>')
    assert f["class_text"] == "hello"
    assert parse_html('<time datetime="x">2024-03-05</time>')["time_text"] == "2024-03-05"
    assert parse_html('<meta property="og:image" content="https://i/x.png">')["og_image"] == "https://i/x.png"
    assert parse_html('<meta property="og:image" content=""><meta property="og:image" content="https://i/y">')[
        "og_image"] is None
    t = parse_html('<title>T</title><script>x</script><style>y</style><!-- c --><p>a b</p>&amp;')
    assert t["text"] == "Ta b&" and t["title"] == "T"
    assert parse_html("<p><b>x<p>y")["text"] == "xy"
    assert parse_html("")["text"] == ""
    assert parse_html(None)["text"] is None


def test_dates_through_spark(spark):
    rows = [(f"u{i}", h) for i, (h, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "url string, html string")
    out = P.extract_fields(P.with_page_fields(df), REF).select("url", "published_day", "bad_date")
    got = {r.url: (r.published_day, r.bad_date) for r in out.collect()}
    for i, (_, day, bad) in enumerate(CASES):
        assert got[f"u{i}"] == (day, bad), CASES[i][0]


def test_text_squeeze_through_spark(spark):
    html = ['<title>T</title><script>x</script><style>y</style><!-- c --><p>a b</p>&amp;',
            "<p>&#12288;あ&#12288;い&#12288;</p>", ""]
    df = spark.createDataFrame([(h,) for h in html], "html string")
    out = P.with_page_fields(df).select(X.squeeze(F.col("page")["text"]).alias("t"))
    assert sorted(r.t for r in out.collect()) == sorted(["Tab&", "あ　い", ""])


@pytest.mark.parametrize("status,err,ok", [(200, None, True), (301, None, True), (404, None, False),
                                           (503, None, False), (None, "timeout", False)])
def test_reachability(spark, status, err, ok):
    pages = spark.createDataFrame([("u", "<p>x</p>", status, err, None)],
                                  "url string, html string, http_status int, fetch_error string, "
                                  "fetched_at timestamp_ntz")
    entries = spark.createDataFrame([("u",), ("missing",)], "url string")
    got = {r.url: (r.reachable, r.reason) for r in P.reachability(entries, pages).collect()}
    assert got["u"][0] is ok
    assert got["missing"] == (False, "no_page")


def test_one_parse_per_page(spark):
    df = spark.createDataFrame([("u", "<time>2024-01-01</time>")], "url string, html string")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        P.extract_fields(P.with_page_fields(df), REF).explain("formatted")
    evals = [ln for ln in buf.getvalue().splitlines() if ln.startswith("Arguments:") and "_parse_pages(" in ln]
    assert len(evals) == 1


def test_unclosed_tags_take_linear_time():
    import time
    for piece in ("<p>x", "<p class='date'>\n", "<time><p class='cal'>x"):
        start = time.process_time()
        parse_html(piece * 20_000)
        assert time.process_time() - start < 2


def test_blocks_are_separated_and_inline_text_is_not():
    r = parse_html("<title>A news</title><h1>zebra</h1><p>one <b>two</b>three<br>four</p>")
    assert r["text"] == "A newszebraone twothreefour"
    assert r["blocks"] == "A news\nzebra\none twothree\nfour"


def test_fields_of_few_pages_are_held_at_once():
    import pyarrow as pa

    from newsloom.functions import html as H
    pages = [None if i % 7 == 0 else f"<title>t{i}</title><p>text {i}</p>" for i in range(2 * H.PAGES_AT_ONCE + 30)]
    parts = list(H.parse_batches(iter([pa.array(pages), pa.array([], pa.string()), pa.array(pages[:5])])))
    assert max(len(p) for p in parts) <= H.PAGES_AT_ONCE
    assert [row for p in parts for row in p.to_pylist()] == [H.parse_html(h) for h in pages + pages[:5]]


def test_plain_tags_are_read_as_the_tokenizer_reads_them():
    """Tags in one step give what the standard library's own steps give."""
    import random
    from html.parser import HTMLParser

    from newsloom.functions import html as H

    class Stock(H.PageParser):
        parse_starttag, parse_endtag, updatepos = HTMLParser.parse_starttag, HTMLParser.parse_endtag, HTMLParser.updatepos

    assert "parse_starttag" in vars(H.PageParser) and "updatepos" in vars(H.PageParser)
    bits = ["<p>", "</p>", "<TIME>", "</time>", "<title>", "</title>", "<script>", "</script>", "</SCRIPT >", "< p>", "</ p>", "<p ",
            "<span class=date>", "</span>", "<br/>", "<!-- c -->", "<![CDATA[x]]>", "<?pi?>", "<!", "<", "</", "</>", "&amp;", "&nbsp",
            "text", "\n", "2024-01-02", "<meta property='og:image' content='u&amp;v'>", "<a-b>", "</a-b>", ">", "<textarea>", "<rt>"]
    rng = random.Random(5)
    for _ in range(3000):
        page = "".join(rng.choice(bits) for _ in range(rng.randint(1, 14)))
        p = Stock()
        p.feed(page)
        assert parse_html(page) == p.result(), page
