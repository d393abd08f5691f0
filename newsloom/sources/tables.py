"""Readers for the landed tables and the article adapter built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.schema import ARTICLE_COLUMNS
from newsloom.session import spread


def read_table(spark: SparkSession, base: str, name: str, spread_out: bool = False) -> DataFrame:
    """Scan one landed table. ``spread_out`` for tables that feed per-row
    heavy work (page parsing, text analysis): a scan that yields fewer
    partitions than task slots is spread round-robin (no-op at scale)."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return spread(df) if spread_out else df


def first_line(text_col) -> F.Column:
    return F.split_part(text_col, F.lit("\n"), F.lit(1))


def articles(spark: SparkSession, base: str) -> DataFrame:
    """Article table derived from ``documents`` and its side tables.

    Every document is one article. ``pages`` gives the url, ``labels`` marks
    the rows whose metadata is already generated, ``events`` gives the
    creation time. All three joins are keyed on the document id, so the
    document side is shuffled once and its partitioning is reused by the
    following joins; AQE turns a join into a broadcast only when the runtime
    size of a side is under the broadcast threshold.
    """
    d = read_table(spark, base, "documents").select("doc_id", "text", "source")
    p = read_table(spark, base, "pages").select(F.col("page_id").alias("doc_id"), "url")
    lab = read_table(spark, base, "labels").select("doc_id", F.lit(True).alias("_lab"))
    e = read_table(spark, base, "events").select(F.col("event_id").alias("doc_id"), "ts")

    joined = (d.join(p, "doc_id", "left")
               .join(lab, "doc_id", "left")
               .join(e, "doc_id", "left"))
    labelled = F.col("_lab").isNotNull()
    line1 = first_line(F.col("text"))
    doc = F.col("doc_id")
    return joined.select(
        F.concat(F.lit("a-"), F.lpad(doc.cast("string"), 12, "0")).alias("id"),
        line1.alias("title"),
        F.coalesce(F.col("url"),
                   F.concat(F.lit("https://example.org/doc/"), doc.cast("string"))).alias("url"),
        F.col("source"),
        F.when(doc % 3 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://img.example.org/"), doc.cast("string"),
                             F.lit(".png"))).alias("image_url"),
        F.col("text").alias("content"),
        F.when(doc % 7 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (doc % 30).cast("int"))
                    .cast("timestamp_ntz")).alias("published_date"),
        F.when(labelled, F.col("text")).alias("summary"),
        F.when(labelled, F.split(line1, " ")).alias("tags"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
        labelled.alias("metadata_generated"),
    ).select(*ARTICLE_COLUMNS)


# Raw source names of the maintenance corpus, in order (these
# are the site names the clean-up and normalisation rules were written for).
RAW_SOURCE_NAMES = (
    "ITmedia", "ITmedia NEWS", "ITmedia Mobile", "ITmedia PC USER",
    "ITmedia エグゼクティブ", "ITmedia エンタープライズ", "ITmedia ビジネスオンライン",
    "マイナビ Tech+ enterprise", "マイナビニュース", "TECH+", "日経クロステック（xTECH）",
    "Semiconductor Today", "GIGAZINE",
)


def doc_number(id_col: str = "id") -> F.Column:
    """Document number encoded in an adapter id ``a-<12 digits>``."""
    return F.substring(F.col(id_col), 3, 12).cast("long")


def source_corpus(spark: SparkSession, base: str) -> DataFrame:
    """Articles whose ``source`` carries the raw site names the maintenance
    scripts clean up (name chosen by document number)."""
    names = F.array(*[F.lit(n) for n in RAW_SOURCE_NAMES])
    idx = (doc_number() % len(RAW_SOURCE_NAMES) + 1).cast("int")
    return articles(spark, base).withColumn("source", F.element_at(names, idx))


def event_batch(spark: SparkSession, base: str) -> DataFrame:
    """An insert batch derived from ``events``: many events per user share a
    url, entries are ordered by event time then id. Part of the urls exist in
    :func:`articles` already."""
    e = read_table(spark, base, "events")
    return e.select(
        F.concat(F.lit("https://example.org/doc/"), (F.col("user_id") * 10).cast("string")).alias("url"),
        F.concat_ws(" ", "event_type", "props").alias("title"),
        F.col("event_type").alias("source"),
        F.col("ts").alias("entry_ts"),
        F.col("event_id").alias("entry_pos"),
    )


def contract_batch(spark: SparkSession, base: str) -> DataFrame:
    """Candidate rows for the row contract: the full first line as title."""
    a = articles(spark, base).select("id", "url", "source", "content")
    return a.select("id", first_line(F.col("content")).alias("title"), "url", "source")


def orders_pages(spark: SparkSession, base: str, spread_out: bool = False) -> DataFrame:
    """Pages built from ``orders`` whose correct date is known: the order
    date written in one of four formats (or ``n/a``, or absent), wrapped as
    ``<time>``, date ``<meta>`` or a date-classed element, with decoys the
    precedence rules must skip. ``og:image`` is filled on half of them, the
    other half has an empty first ``og:image``."""
    o = read_table(spark, base, "orders", spread_out).select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    fmt = k % 6
    wrap = F.floor(k / 6) % 3
    d = F.col("o_orderdate")
    s = (F.when(fmt == 0, F.date_format(d, "yyyy-MM-dd"))
          .when(fmt == 1, F.date_format(d, "MMMM d, yyyy"))
          .when(fmt == 2, F.date_format(d, "yyyy/M/d"))
          .when(fmt == 3, F.date_format(d, "yyyy年M月d日"))
          .when(fmt == 4, F.lit("n/a")))
    date_el = (F.when(s.isNull(), F.lit(""))
                .when(wrap == 0, F.concat(F.lit("<time datetime=\"1999-01-01\">"), s, F.lit("</time>"),
                                          F.lit("<meta property=\"date\" content=\"1999-02-02\">")))
                .when(wrap == 1, F.concat(F.lit("<meta property=\"article:published_time\" "
                                                "content=\"1999-03-03\"><meta property=\"date\" content=\""),
                                          s, F.lit("\">")))
                .otherwise(F.concat(F.lit("<p class=\"local\"></p><span class=\"post-date\"> "), s,
                                    F.lit(" </span>"))))
    img = F.concat(F.lit("https://img.example.org/o"), k.cast("string"), F.lit(".png"))
    og = F.when(F.floor(k / 6) % 2 == 0,
                F.concat(F.lit("<meta property=\"og:image\" content=\""), img, F.lit("\">"))) \
          .otherwise(F.concat(F.lit("<meta property=\"og:image\" content=\"\">"
                                    "<meta property=\"og:image\" content=\""), img, F.lit("\">")))
    html = F.concat(F.lit("<!DOCTYPE html><html><head><title>Order "), k.cast("string"),
                    F.lit("</title>"), og, F.lit("</head><body><article><h1>Order "), k.cast("string"),
                    F.lit("</h1>"), date_el, F.lit("<p>Total &amp; more</p></article></body></html>"))
    return o.select("o_orderkey", "o_orderdate",
                    F.concat(F.lit("https://shop.example.org/o/"), k.cast("string")).alias("url"),
                    html.alias("html"), s.alias("date_string"))


def _xml_escape(col: F.Column) -> F.Column:
    return F.replace(F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def page_feeds(spark: SparkSession, base: str):
    """Feeds and landed fetches built from ``pages`` (checks of the collect
    path). One feed per page, as RSS 2.0, RSS 1.0 (RDF) or Atom by page
    number, listing: its own page (``#f`` link), the next page, an entry
    without link, and an entry without title whose link was never fetched.
    Every 25th feed is an unreadable document.

    Returns ``(catalogue, landed_feeds, landed_pages)``.
    """
    import datetime as _dt

    from newsloom.sources.feeds import feed_key
    from newsloom.sources.pages import landed_from_table

    p = read_table(spark, base, "pages").select("page_id", "url")
    nxt = p.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    j = p.join(nxt, "page_id", "left")
    pid = F.col("page_id").cast("string")
    feed_url = F.concat(F.lit("https://feeds.example.org/"), pid)
    fmt = F.col("page_id") % 3

    def item(title, link):
        t = F.concat(F.lit("<title>"), title, F.lit("</title>")) if title is not None else F.lit("")
        lk = _xml_escape(link) if link is not None else None
        rss = F.concat(F.lit("<item>"), t,
                       F.concat(F.lit("<link>"), lk, F.lit("</link>")) if lk is not None else F.lit(""),
                       F.lit("</item>"))
        rdf = F.concat(F.lit("<item rdf:about=\""), lk if lk is not None else F.lit("x"), F.lit("\">"), t,
                       F.concat(F.lit("<link>"), lk, F.lit("</link>")) if lk is not None else F.lit(""),
                       F.lit("</item>"))
        atom = F.concat(F.lit("<entry>"), t, F.lit("<link rel=\"self\" href=\"https://self.example/\"/>"),
                        F.concat(F.lit("<link rel=\"alternate\" href=\""), lk, F.lit("\"/>"))
                        if lk is not None else F.lit(""), F.lit("</entry>"))
        return F.when(fmt == 0, rss).when(fmt == 1, rdf).otherwise(atom)

    a = item(F.concat(F.lit("A"), pid), F.concat(F.col("url"), F.lit("#f")))
    b = F.when(F.col("next_url").isNotNull(),
               item(F.concat(F.lit("B"), pid), F.concat(F.col("next_url"), F.lit("#f")))).otherwise(F.lit(""))
    c = item(F.concat(F.lit("C"), pid), None)
    d = item(None, F.col("url"))
    items = F.concat(a, b, c, d)
    body = (F.when(F.col("page_id") % 25 == 24, F.lit("<rss><channel><item><title>broken"))
             .when(fmt == 0, F.concat(F.lit("<rss version=\"2.0\"><channel><title>F</title>"), items,
                                      F.lit("</channel></rss>")))
             .when(fmt == 1, F.concat(
                 F.lit("<rdf:RDF xmlns:rdf=\"http://www.w3.org/1999/02/22-rdf-syntax-ns#\" "
                       "xmlns=\"http://purl.org/rss/1.0/\"><channel rdf:about=\"https://feeds.example.org/\">"
                       "<title>F</title></channel>"), items, F.lit("</rdf:RDF>")))
             .otherwise(F.concat(F.lit("<feed xmlns=\"http://www.w3.org/2005/Atom\"><title>F</title>"),
                                 items, F.lit("</feed>"))))
    cat = j.select(
        F.concat(F.lit("Feed "), (F.col("page_id") % 5).cast("string")).alias("source"),
        F.col("page_id").cast("int").alias("source_pos"), feed_url.alias("feed_url"),
        F.lit(0).alias("feed_pos"), F.lit("technology").alias("category"),
        feed_key(feed_url).alias("feed_key"))
    landed = j.select(feed_key(feed_url).alias("feed_key"), F.lit("r1").alias("run_id"),
                      body.alias("body"))
    pages = landed_from_table(
        read_table(spark, base, "pages", spread_out=True).withColumn("url", F.concat(F.col("url"), F.lit("#f"))),
        _dt.datetime(2026, 12, 1, 5, 0, 0))
    return cat, landed, pages


def order_feeds(spark: SparkSession, base: str):
    """Feeds, fetches and existing urls built from ``orders`` (checks of the
    collect path with known results). One RSS feed per order, written
    carelessly: a bare ampersand and an HTML entity in every title. By the
    last digit of the order key: 2 lists its page twice; 3 has a title over
    the limit; 4 an impossible date; 5 is in the table already; 6 was not
    found; 7 was fetched twice, first with another date and image; 8 is no
    feed of the catalogue; 9 has an entry without link.

    Returns ``(catalogue, landed_feeds, landed_pages, existing)``.
    """
    import datetime as _dt

    from newsloom.functions.times import ntz
    from newsloom.sources.feeds import feed_key

    o = read_table(spark, base, "orders", True).select("o_orderkey", "o_orderdate")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    n, key = k % 10, F.col("o_orderkey").cast("string")
    url = F.concat(F.lit("https://shop.example.org/o/"), key)
    feed = F.concat(F.lit("https://feeds.example.org/o/"), key)
    title = F.when(n == 3, F.repeat(F.lit("x"), 501)).otherwise(F.concat(F.lit("Order & "), key, F.lit("&nbsp;x")))
    entry = F.concat(F.lit("<item><title>"), title, F.lit("</title>"),
                     F.when(n == 9, F.lit("")).otherwise(F.concat(F.lit("<link>"), url, F.lit("</link>"))), F.lit("</item>"))
    again = F.when(n == 2, F.concat(F.lit("<item><title>Again</title><link>"), url, F.lit("</link></item>"))).otherwise(F.lit(""))
    landed = o.select(feed_key(feed).alias("feed_key"), F.lit("r1").alias("run_id"), F.concat(
        F.lit("<rss version=\"2.0\"><channel><title>Orders</title>"), entry, again,
        F.lit("</channel></rss>")).alias("body"))
    catalogue = o.filter(n != 8).select(
        F.lit("Shop").alias("source"), F.lit(0).alias("source_pos"), feed.alias("feed_url"), k.cast("int").alias("feed_pos"),
        F.lit("orders").alias("category"), feed_key(feed).alias("feed_key"))
    written = (F.when(n == 4, F.lit("2024-13-45")).when(k % 6 == 0, F.date_format(d, "yyyy-MM-dd"))
               .when(k % 6 == 1, F.date_format(d, "MMMM d, yyyy")).when(k % 6 == 2, F.date_format(d, "yyyy/M/d"))
               .when(k % 6 == 3, F.date_format(d, "yyyy年M月d日")).when(k % 6 == 4, F.lit("n/a")).otherwise(F.lit("")))
    image = F.concat(F.lit("https://img.example.org/o"), key, F.lit(".png"))

    def page(day, img, when, rows):
        html = F.concat(F.lit("<html><head><meta property=\"og:image\" content=\""), img,
                        F.lit("\"></head><body><time>"), day, F.lit("</time><p>text</p></body></html>"))
        return rows.select(url.alias("url"), html.alias("html"), F.when(n == 6, 404).otherwise(200).alias("http_status"),
                           F.lit(None).cast("string").alias("fetch_error"), ntz(when).alias("fetched_at"))
    first, later = _dt.datetime(2026, 12, 1, 4), _dt.datetime(2026, 12, 1, 5)
    pages = page(written, image, later, o).unionByName(
        page(F.lit("1999-01-01"), F.lit("https://img.example.org/old.png"), first, o.filter(n == 7)))
    return catalogue, landed, pages, o.filter(n == 5).select(url.alias("url"))
