"""Collect-path queries over feeds built from the pages table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from newsloom.checkout import sql_ts
from newsloom.operators import writes
from newsloom.plans import collect as C
from newsloom.registered.base import ARTICLES_CTE
from newsloom.registry import register
from newsloom.session import cut_lineage
from newsloom.sources import feeds as FD
from newsloom.sources.tables import articles, order_feeds, page_feeds, read_table

NOW = _dt.datetime(2026, 12, 1, 5, 0, 0)
_CREATED = sql_ts("TIMESTAMP '2026-12-01 05:00:00'")
REF = _dt.date(2026, 12, 1)

_ENTRIES_CTE = """ent AS (
  SELECT page_id AS fid, 0 AS pos, 'A' || CAST(page_id AS VARCHAR) AS title, url || '#f' AS link,
         page_id AS target FROM pages WHERE page_id % 25 <> 24
  UNION ALL
  SELECT p.page_id, 1, 'B' || CAST(p.page_id AS VARCHAR), n.url || '#f', n.page_id
  FROM pages p JOIN pages n ON n.page_id = p.page_id + 1 WHERE p.page_id % 25 <> 24
  UNION ALL
  SELECT page_id, 2, 'C' || CAST(page_id AS VARCHAR), NULL, NULL FROM pages WHERE page_id % 25 <> 24
  UNION ALL
  SELECT page_id, 3, 'No Title', url, NULL FROM pages WHERE page_id % 25 <> 24
),
lab AS (
  SELECT *, CASE
      WHEN link IS NULL THEN 'no_link'
      WHEN target IS NULL OR target % 10 IN (3, 7, 9) THEN 'unreachable'
      WHEN row_number() OVER (PARTITION BY link ORDER BY fid, pos) = 1
           AND NOT EXISTS (SELECT 1 FROM articles a WHERE a.url = ent.link) THEN 'inserted'
      ELSE 'conflict' END AS outcome
  FROM ent
)"""


def _sql(body):
    return "WITH " + ARTICLES_CTE + ",\n" + _ENTRIES_CTE + "\n" + body


def _collect(spark, sf):
    cat, landed, pages = page_feeds(spark, sf)
    return C.collect(cat, landed, pages, articles(spark, sf), NOW, REF)


_ALL_ENTRIES_SQL = (
    "SELECT sha1('https://feeds.example.org/' || CAST(fid AS VARCHAR)) AS feed_key, pos, title, link FROM ("
    "  SELECT page_id AS fid, 0 AS pos, 'A' || CAST(page_id AS VARCHAR) AS title, url || '#f' AS link FROM pages"
    "  UNION ALL SELECT p.page_id, 1, 'B' || CAST(p.page_id AS VARCHAR), n.url || '#f'"
    "    FROM pages p JOIN pages n ON n.page_id = p.page_id + 1"
    "  UNION ALL SELECT p.page_id, CASE WHEN n.page_id IS NULL THEN 1 ELSE 2 END, 'C' || CAST(p.page_id AS VARCHAR), NULL"
    "    FROM pages p LEFT JOIN pages n ON n.page_id = p.page_id + 1"
    "  UNION ALL SELECT p.page_id, CASE WHEN n.page_id IS NULL THEN 2 ELSE 3 END, {untitled}, p.url"
    "    FROM pages p LEFT JOIN pages n ON n.page_id = p.page_id + 1) e WHERE fid % 25 <> 24")


@register("s2_feed_entries", _ALL_ENTRIES_SQL.format(untitled="CAST(NULL AS VARCHAR)"))
def s2_feed_entries(spark, sf):
    """Every entry read back from the generated documents of all three feed
    formats; unreadable documents give none."""
    _, landed, _ = page_feeds(spark, sf)
    return FD.entries(landed).filter("feed_ok").select("feed_key", F.col("entry_pos").alias("pos"), "title", "link")


@register("c1_collect_outcomes", _sql(
    "SELECT outcome, count(*) AS count FROM ("
    "  SELECT outcome FROM lab UNION ALL"
    "  SELECT 'rejected' FROM pages WHERE page_id % 25 = 24) t GROUP BY outcome"))
def c1_collect_outcomes(spark, sf):
    return C.outcome_counts(_collect(spark, sf).outcomes)


@register("c1_collect_rows", _sql(
    "SELECT link AS url, title, 'Feed ' || CAST(fid % 5 AS VARCHAR) AS source, "
    "CAST(NULL AS VARCHAR) AS published_date, CAST(NULL AS VARCHAR) AS image_url, sha256(link) AS id, "
    f"{_CREATED} AS created_at, false AS metadata_generated "
    "FROM lab WHERE outcome = 'inserted'"))
def c1_collect_rows(spark, sf):
    rows = _collect(spark, sf).rows
    return rows.select("url", "title", "source", "published_date", "image_url", "id",
                       "created_at", "metadata_generated")


@register("x19_f11_entry_fields",
          "SELECT feed_key, pos, title, link IS NOT NULL AS has_link FROM (" +
          _ALL_ENTRIES_SQL.format(untitled="'No Title'") + ") t")
def x19_f11_entry_fields(spark, sf):
    """Titles, 'No Title' where an entry has none, and whether it has a link."""
    _, landed, _ = page_feeds(spark, sf)
    return FD.entries(landed).filter("feed_ok").select(
        "feed_key", F.col("entry_pos").alias("pos"), FD.title_or_default().alias("title"), FD.has_link().alias("has_link"))


# -- feeds over orders: dates, images, rejects, refetches, known urls ---------
_ORDERS_CTE = f"""o AS (
  SELECT o_orderkey AS k, o_orderkey % 10 AS n, 'https://shop.example.org/o/' || CAST(o_orderkey AS VARCHAR) AS url,
         CASE WHEN o_orderkey % 10 <> 4 AND o_orderkey % 6 < 4 THEN {sql_ts("CAST(o_orderdate AS TIMESTAMP)")} END AS day
  FROM orders)"""


def _orders(spark, sf):
    return C.collect(*order_feeds(spark, sf), NOW, REF)


@register("c1_order_rows", f"WITH {_ORDERS_CTE} SELECT sha256(url) AS id, url, 'Order & ' || CAST(k AS VARCHAR) || "
          "chr(160) || 'x' AS title, 'Shop' AS source, day AS published_date, n = 4 AS bad_date, "
          f"'https://img.example.org/o' || CAST(k AS VARCHAR) || '.png' AS image_url, {_CREATED} AS created_at "
          "FROM o WHERE n IN (0, 1, 2, 4, 7)")
def c1_order_rows(spark, sf):
    """Inserted rows with known dates and images, one per url although some
    pages were fetched twice."""
    out = _orders(spark, sf).outcomes.filter("outcome = 'inserted'")
    return out.select("id", "url", "title", "source", "published_date", "bad_date", "image_url", "created_at")


@register("c1_order_outcomes", f"WITH {_ORDERS_CTE} SELECT outcome, reason, count(*) AS count FROM ("
          "SELECT CASE n WHEN 3 THEN 'rejected' WHEN 5 THEN 'conflict' WHEN 6 THEN 'unreachable' WHEN 8 THEN 'rejected' "
          "WHEN 9 THEN 'no_link' ELSE 'inserted' END AS outcome, CASE n WHEN 3 THEN 'title_too_long' WHEN 6 THEN 'http_404' "
          "WHEN 8 THEN 'unknown_feed' WHEN 9 THEN 'no_link' END AS reason FROM o "
          "UNION ALL SELECT 'conflict', NULL FROM o WHERE n = 2) t GROUP BY outcome, reason")
def c1_order_outcomes(spark, sf):
    return _orders(spark, sf).outcomes.groupBy("outcome", "reason").agg(F.count(F.lit(1)).alias("count"))


@register("c1_refetched_pages", f"WITH {_ORDERS_CTE} SELECT url, n <> 6 AS reachable, CASE WHEN n <> 6 THEN day END AS published_day, "
          "CASE WHEN n <> 6 THEN 'https://img.example.org/o' || CAST(k AS VARCHAR) || '.png' END AS image_url FROM o")
def c1_refetched_pages(spark, sf):
    """One row per url of all landed pages, with the fields of the later
    fetch where a page was fetched twice."""
    last = C.page_fields(order_feeds(spark, sf)[2], REF)
    return last.select("url", "reachable", F.col("published_day").cast("timestamp_ntz").alias("published_day"), "image_url")


# -- two collects in sequence -------------------------------------------------
NEXT_DAY = _dt.datetime(2026, 12, 2, 5, 0, 0)
_NEXT = sql_ts("TIMESTAMP '2026-12-02 05:00:00'")
_TWO_CTE = (_ORDERS_CTE + ", d AS (SELECT *, sha1('https://feeds.example.org/o/' || CAST(k AS VARCHAR))[1] < '8' AS early FROM o)")


_TWO_COLUMNS = ["url", "title", "published_date", "created_at"]


def _two_collects(spark, sf):
    """Some feeds land on the first day, all of them (with other titles) on
    the second; the second run meets the first one's urls. Of the first run
    only what is asked for later is written down."""
    cat, landed, pages, known = order_feeds(spark, sf)
    first = C.collect(cat, landed.filter(F.substring("feed_key", 1, 1) < "8"), pages, known, NOW, REF).outcomes
    first = cut_lineage(first.select("outcome", *_TWO_COLUMNS))
    late = landed.select("feed_key", F.lit("r2").alias("run_id"), F.replace("body", F.lit("Order &"), F.lit("Late &")).alias("body"))
    have = known.unionByName(first.filter("outcome = 'inserted'").select("url"))
    return first, C.collect(cat, late, pages, have, NEXT_DAY, REF).outcomes


@register("i1_two_collects", f"WITH {_TWO_CTE} SELECT url, CASE WHEN early THEN 'Order & ' ELSE 'Late & ' END || CAST(k AS VARCHAR) || "
          f"chr(160) || 'x' AS title, day AS published_date, CASE WHEN early THEN {_CREATED} ELSE {_NEXT} END AS created_at "
          "FROM d WHERE n IN (0, 1, 2, 4, 7)")
def i1_two_collects(spark, sf):
    """Rows after two collect runs: the first run's title stays."""
    first, second = _two_collects(spark, sf)
    return first.unionByName(second.select(*first.columns)).filter("outcome = 'inserted'").select(*_TWO_COLUMNS)


_OUTCOME = ("CASE n WHEN 3 THEN 'rejected' WHEN 5 THEN 'conflict' WHEN 6 THEN 'unreachable' WHEN 8 THEN 'rejected' "
            "WHEN 9 THEN 'no_link' ELSE {new} END")


@register("i1_two_outcomes", f"WITH {_TWO_CTE} SELECT run, outcome, count(*) AS count FROM ("
          f"SELECT 1 AS run, {_OUTCOME.format(new=chr(39) + 'inserted' + chr(39))} AS outcome FROM d WHERE early "
          "UNION ALL SELECT 1, 'conflict' FROM d WHERE early AND n = 2 "
          f"UNION ALL SELECT 2, {_OUTCOME.format(new='CASE WHEN early THEN ' + chr(39) + 'conflict' + chr(39) + ' ELSE ' + chr(39) + 'inserted' + chr(39) + ' END')} FROM d "
          "UNION ALL SELECT 2, 'conflict' FROM d WHERE n = 2) t GROUP BY run, outcome")
def i1_two_outcomes(spark, sf):
    """Entries by run and outcome: what the first run inserted is a conflict
    of the second."""
    runs = [o.select(F.lit(i + 1).alias("run"), "outcome") for i, o in enumerate(_two_collects(spark, sf))]
    return runs[0].unionByName(runs[1]).groupBy("run", "outcome").agg(F.count(F.lit(1)).alias("count"))


# -- catalogue ----------------------------------------------------------------
@register("s1_catalogue", """
SELECT source, source_pos, feed_url, feed_pos, coalesce(category, 'unknown') AS category, sha1(feed_url) AS feed_key
FROM (SELECT 'Site ' || source AS source, 0 AS source_pos, 'https://f.example/' || CAST(doc_id AS VARCHAR) || '/a' AS feed_url,
             0 AS feed_pos, lang AS category FROM documents WHERE doc_id % 7 <> 0
      UNION ALL SELECT 'Site ' || source, 0, 'https://f.example/' || CAST(doc_id AS VARCHAR) || '/b', 1, NULL FROM documents WHERE doc_id % 7 <> 0
      UNION ALL SELECT 'Second', 2, 'https://g.example/' || CAST(doc_id AS VARCHAR), 0, source FROM documents) t""")
def s1_catalogue(spark, sf):
    """Catalogues derived from the documents, one each, flattened: sources in
    order, some without feeds, feeds with and without category."""
    key = F.col("doc_id").cast("string")
    feed = lambda url, category: F.struct(url.alias("url"), category.alias("category"))
    base = F.concat(F.lit("https://f.example/"), key)
    none = F.lit(None).cast("string")
    own = F.when(F.col("doc_id") % 7 != 0, F.array(feed(F.concat(base, F.lit("/a")), F.col("lang")), feed(F.concat(base, F.lit("/b")), none)))
    nested = read_table(spark, sf, "documents").select(F.array(
        F.struct(F.concat(F.lit("Site "), F.col("source")).alias("source"), own.alias("feeds")),
        F.struct(F.lit("Empty").alias("source"), F.lit(None).cast("array<struct<url:string,category:string>>").alias("feeds")),
        F.struct(F.lit("Second").alias("source"), F.array(feed(F.concat(F.lit("https://g.example/"), key), F.col("source"))).alias("feeds")),
    ).alias("sources"))
    return FD.flatten_catalogue(nested)


@register("a8_run_counters", f"WITH {_ORDERS_CTE} SELECT count(*) FILTER (n IN (0, 1, 2, 4, 5, 7)) + "
          "count(*) FILTER (n = 2) AS attempted, count(*) FILTER (n IN (0, 1, 2, 4, 7)) AS inserted, "
          "count(*) FILTER (n IN (2, 5)) AS conflicts, count(*) FILTER (n IN (3, 6, 8, 9)) AS skipped FROM o")
def a8_run_counters(spark, sf):
    return writes.run_counters(_orders(spark, sf).outcomes)
