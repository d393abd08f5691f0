"""Feed catalogue, entry scan, collect and incremental collect (FIXTURES
section 7), on small files written by the test."""

import datetime as dt
import hashlib
import os

from pyspark.sql import functions as F

from newsloom.plans import collect as C
from newsloom.sources import feeds as FD
from newsloom.sources.store import ArticleTable
from newsloom.streaming.incremental import collect_stream

NOW = dt.datetime(2026, 12, 1, 5)
REF = dt.date(2026, 12, 1)

CONFIG = {"sources": {
    "Alpha": {"feeds": [{"url": "https://a.example/rss", "category": "tech"},
                        {"url": "https://a.example/rdf"}]},
    "Empty": {},
    "Beta": {"feeds": [{"url": "https://b.example/atom", "category": "science"},
                       {"url": "https://b.example/broken"}]},
}}

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>A</title>
<item><title><![CDATA[A & <b>B</b>]]></title><link>https://x.example/1</link></item>
<item><link>https://x.example/2</link></item>
<item><title></title><link>https://x.example/3</link></item>
<item><title>no link</title></item>
<item><title>empty link</title><link></link></item>
</channel></rss>"""
RDF = """<?xml version="1.0"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"
 xmlns="http://purl.org/rss/1.0/"><channel rdf:about="https://a.example/"><title>R</title></channel>
<item rdf:about="https://x.example/4"><title>R4</title><link>https://x.example/4</link></item>
<item rdf:about="https://x.example/1"><title>R1 later</title><link>https://x.example/1</link></item>
</rdf:RDF>"""
ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>B</title>
<entry><title>B5</title><link rel="self" href="https://x.example/self"/>
<link rel="alternate" href="https://x.example/5"/></entry>
<entry><title>B6</title><link href="https://x.example/6"/></entry></feed>"""
BROKEN = "<rss><channel><item><title>broken"


def key(url):
    return hashlib.sha1(url.encode()).hexdigest()


def land(folder, url, run, body):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{key(url)}.{run}.xml"), "w", encoding="utf-8") as fh:
        fh.write(body)


def pages_df(spark, urls, status=200):
    rows = [(u, f"<html><head><meta property='og:image' content='{u}.png'></head>"
                f"<body><time>2024-03-0{i % 9 + 1}</time><p>t</p></body></html>", status, None, NOW)
            for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "url string, html string, http_status int, fetch_error string, "
                                       "fetched_at timestamp_ntz")


def test_catalogue(spark):
    cat = FD.catalogue(spark, CONFIG)
    rows = [tuple(r) for r in cat.select("source", "source_pos", "feed_url", "feed_pos", "category").collect()]
    assert sorted(rows) == sorted([
        ("Alpha", 0, "https://a.example/rss", 0, "tech"),
        ("Alpha", 0, "https://a.example/rdf", 1, "unknown"),
        ("Beta", 2, "https://b.example/atom", 0, "science"),
        ("Beta", 2, "https://b.example/broken", 1, "unknown")])
    assert {r.feed_key for r in cat.collect()} == {key(u) for _, _, u, _, _ in rows}


def test_entries_shapes(spark, scratch):
    land(scratch, "https://a.example/rss", "r1", RSS)
    land(scratch, "https://a.example/rdf", "r1", RDF)
    land(scratch, "https://b.example/atom", "r1", ATOM)
    land(scratch, "https://b.example/broken", "r1", BROKEN)
    e = FD.entries(FD.read_landed(spark, scratch)).withColumn("t", FD.title_or_default())
    got = {(r.feed_key, r.entry_pos): (r.t, r.link, r.feed_ok) for r in e.collect()}
    rk = key("https://a.example/rss")
    assert got[(rk, 0)] == ("A & <b>B</b>", "https://x.example/1", True)
    assert got[(rk, 1)] == ("No Title", "https://x.example/2", True)
    assert got[(rk, 2)] == ("", "https://x.example/3", True)
    assert got[(rk, 3)][1] is None and got[(rk, 4)][1] == ""
    assert got[(key("https://a.example/rdf"), 1)] == ("R1 later", "https://x.example/1", True)
    assert got[(key("https://b.example/atom"), 0)] == ("B5", "https://x.example/5", True)
    assert got[(key("https://b.example/atom"), 1)] == ("B6", "https://x.example/6", True)
    assert got[(key("https://b.example/broken"), None)] == ("No Title", None, False)


def test_collect_first_wins_and_outcomes(spark, scratch):
    land(scratch, "https://a.example/rss", "r1", RSS)
    land(scratch, "https://a.example/rdf", "r1", RDF)
    land(scratch, "https://b.example/atom", "r1", ATOM)
    land(scratch, "https://b.example/broken", "r1", BROKEN)
    urls = [f"https://x.example/{i}" for i in (1, 2, 3, 4, 5)]
    pages = pages_df(spark, urls).unionByName(pages_df(spark, ["https://x.example/6"], 404))
    empty = spark.createDataFrame([], "url string")
    res = C.collect(FD.catalogue(spark, CONFIG), FD.read_landed(spark, scratch), pages, empty, NOW, REF)
    rows = {r.url: r for r in res.rows.collect()}
    assert set(rows) == set(urls)
    assert rows["https://x.example/1"].title == "A & <b>B</b>"          # earlier catalogue position
    assert rows["https://x.example/1"].image_url == "https://x.example/1.png"
    assert rows["https://x.example/2"].title == "No Title"
    assert rows["https://x.example/1"].published_date == dt.datetime(2024, 3, 1)
    counts = {r.outcome: r["count"] for r in C.outcome_counts(res.outcomes).collect()}
    assert counts == {"inserted": 5, "conflict": 1, "no_link": 2, "unreachable": 1, "rejected": 1}


def test_incremental_collect_stream(spark, scratch):
    landing = os.path.join(scratch, "landing")
    store = ArticleTable(spark, "t_stream", os.path.join(scratch, "store"), parts=4)
    cat = FD.catalogue(spark, {"sources": {"S": {"feeds": [{"url": "https://f/1"}]}}})
    pages = pages_df(spark, ["u1", "u2", "u3"])
    ckpt = os.path.join(scratch, "ckpt")

    def run():
        q = collect_stream(spark, landing, store, cat, lambda: pages, lambda: NOW, lambda: REF, ckpt)
        q.awaitTermination()

    one = "<rss><channel><item><title>{t}</title><link>{u}</link></item></channel></rss>"
    land(landing, "https://f/1", "20261201", one.format(t="first", u="u1").replace(
        "</channel>", "<item><title>second</title><link>u2</link></item></channel>"))
    run()
    first = sorted((r.url, r.title) for r in store.read().collect())
    assert first == [("u1", "first"), ("u2", "second")]
    run()                                    # nothing new landed
    assert sorted((r.url, r.title) for r in store.read().collect()) == first
    land(landing, "https://f/1", "20261202", one.format(t="late", u="u3").replace(
        "</channel>", "<item><title>changed</title><link>u1</link></item></channel>"))
    run()
    assert sorted((r.url, r.title) for r in store.read().collect()) == \
        [("u1", "first"), ("u2", "second"), ("u3", "late")]


def _entries(spark, *bodies):
    df = spark.createDataFrame([(f"k{i}", "r", b) for i, b in enumerate(bodies)], "feed_key string, run_id string, body string")
    return [(r.feed_key, r.title, r.link, r.feed_ok) for r in FD.entries(df).orderBy("feed_key", "entry_pos").collect()]


def test_careless_feeds_are_read(spark):
    item = "<item><title>{}</title><link>http://x/?a=1{}b=2</link></item>"
    got = _entries(
        spark, "<rss><channel>" + item.format("Q & A", "&") + "</channel></rss>",
        "<rss><channel>" + item.format("a&nbsp;b &eacute; &bogus; &amp; &#65;", "&amp;") + "</channel></rss>",
        "<rss><channel><item><title><![CDATA[x & <i>y</i> &amp;]]></title><link>u</link></item></channel></rss>",
        "<rss><channel>" + item.format("whole", "&amp;") + "<item><title>cut off",
        "<feed><entry><title type='html'>&lt;b&gt;x&lt;/b&gt;</title><link href='u'/></entry></feed>")
    assert got == [("k0", "Q & A", "http://x/?a=1&b=2", True),
                   ("k1", "a\u00a0b \u00e9 &bogus; & A", "http://x/?a=1&b=2", True),
                   ("k2", "x & <i>y</i> &amp;", "u", True),
                   ("k3", "whole", "http://x/?a=1&b=2", True),
                   ("k4", "<b>x</b>", "u", True)]


def test_empty_feed_is_readable_and_other_documents_are_not(spark):
    got = _entries(spark, "<rss><channel><title>F</title></channel></rss>",
                   "<feed xmlns='http://www.w3.org/2005/Atom'><title>F</title></feed>",
                   "<html><body>x</body></html>", "not xml", "")
    assert got == [("k2", None, None, False), ("k3", None, None, False), ("k4", None, None, False)]


def test_unknown_feeds_and_refetched_pages(spark, scratch):
    land(scratch, "https://a.example/rss", "r1", RSS)
    land(scratch, "https://nobody.example/rss", "r1", RSS)
    with open(os.path.join(scratch, "odd-name.xml"), "w", encoding="utf-8") as fh:
        fh.write(RSS)
    old = pages_df(spark, ["https://x.example/1", "https://x.example/2"])
    new = old.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 HOUR")) \
             .withColumn("html", F.replace("html", F.lit("2024-03-0"), F.lit("2025-03-0")))
    res = C.collect(FD.catalogue(spark, CONFIG), FD.read_landed(spark, scratch), old.unionByName(new),
                    spark.createDataFrame([], "url string"), NOW, REF)
    rows = {r.url: r for r in res.rows.collect()}
    assert len(rows) == res.rows.count() == 2
    assert rows["https://x.example/1"].published_date == dt.datetime(2025, 3, 1)
    unknown = res.outcomes.filter("reason = 'unknown_feed'")
    assert unknown.count() == 10 and unknown.filter("outcome <> 'rejected'").count() == 0
