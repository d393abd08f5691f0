"""The work of a collect run follows what is new: pages are pruned below the
parse, batches are bounded."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from newsloom.plans import collect as C
from newsloom.sources import feeds as FD
from newsloom.sources import pages as P
from newsloom.sources.store import ArticleTable
from newsloom.streaming.incremental import collect_stream
from tests.test_feeds import NOW, REF, RSS, land, pages_df

CONFIG = {"sources": {"Alpha": {"feeds": [{"url": "https://a.example/rss"}]}}}


def parsed_rows(df):
    """Rows that the page parse put out when ``df`` ran."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName() == "ArrowEvalPython":
            found += node.metrics().apply("pythonNumRowsReceived").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return found


def landed_pages(spark, scratch, n=400):
    """Pages of ``n`` urls, each fetched twice; every tenth one failed last."""
    urls = [f"https://x.example/{i}" for i in range(n)]
    old = pages_df(spark, urls)
    failed = (F.regexp_extract("url", r"(\d+)$", 1).cast("int") % 10 == 3)
    new = old.withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 HOUR")) \
             .withColumn("http_status", F.when(failed, 500).otherwise(200))
    old.unionByName(new).repartition(4).write.parquet(scratch + "/pages")
    return spark.read.parquet(scratch + "/pages")


def test_only_pages_of_new_urls_are_parsed(spark, scratch):
    pages = landed_pages(spark, scratch)
    # /1, /2 and /3 are listed; /2 is in the table, /3 failed: one page is parsed.
    land(scratch + "/feeds", "https://a.example/rss", "r1", RSS)
    have = spark.createDataFrame([("https://x.example/2",)], "url string")
    linked = spark.createDataFrame([(f"https://x.example/{i}",) for i in (1, 2, 3)], "url string")
    states = P.fetch_states(pages, linked)
    assert {(r.url[-1], r.reachable, r.page_reason) for r in states.collect()} == {("1", True, None), ("2", True, None), ("3", False, "http_500")}
    assert P.pages_to_parse(pages, states.filter("url LIKE '%/1' OR url LIKE '%/3'")).count() == 1
    res = C.collect(FD.catalogue(spark, CONFIG), FD.read_landed(spark, scratch + "/feeds"), pages, have, NOW, REF)
    assert parsed_rows(res.outcomes) == 1
    rows = res.rows.collect()
    assert [(r.url, r.published_date, r.image_url) for r in rows] == [
        ("https://x.example/1", dt.datetime(2024, 3, 2), "https://x.example/1.png")]
    assert {r.outcome: r["count"] for r in C.outcome_counts(res.outcomes).collect()} == {
        "inserted": 1, "conflict": 1, "unreachable": 1, "no_link": 2}
    none = C.collect(FD.catalogue(spark, CONFIG), FD.read_landed(spark, scratch + "/feeds"), pages,
                     have.unionByName(res.rows.select("url")), NOW, REF)
    assert parsed_rows(none.outcomes) == 0 and none.rows.count() == 0


def test_entries_meet_what_is_known_of_their_urls_once(spark, scratch):
    """The entries that were written down are read for those with a url and
    those without, no more; a url that the table names twice or that failed
    multiplies nothing."""
    pages = landed_pages(spark, scratch)
    land(scratch + "/feeds", "https://a.example/rss", "r1", RSS)
    land(scratch + "/feeds", "https://a.example/rss", "r2", RSS)
    have = spark.createDataFrame([("https://x.example/2",)] * 3 + [("https://x.example/3",), (None,)], "url string")
    res = C.collect(FD.catalogue(spark, CONFIG), FD.read_landed(spark, scratch + "/feeds"), pages, have, NOW, REF)
    plan = res.outcomes._jdf.queryExecution().optimizedPlan().toString()
    assert sum("LogicalRDD" in line and "feed_key" in line for line in plan.splitlines()) == 2
    got = sorted((r.run_id, r.entry_pos, r.outcome, r.reason, r.image_url) for r in res.outcomes.collect())
    assert got == [
        ("r1", 0, "inserted", None, "https://x.example/1.png"), ("r1", 1, "conflict", None, None),
        ("r1", 2, "unreachable", "http_500", None), ("r1", 3, "no_link", "no_link", None), ("r1", 4, "no_link", "no_link", None),
        ("r2", 0, "conflict", None, None), ("r2", 1, "conflict", None, None),
        ("r2", 2, "unreachable", "http_500", None), ("r2", 3, "no_link", "no_link", None), ("r2", 4, "no_link", "no_link", None)]


def test_first_acceptable_entry_is_taken_not_the_first(spark, scratch):
    """An entry that breaks the contract does not keep its url from a later one."""
    pages = landed_pages(spark, scratch, 5)
    item = "<rss><channel><item><title>{}</title><link>https://x.example/1</link></item></channel></rss>"
    land(scratch + "/feeds", "https://a.example/rss", "r1", item.format("x" * 501))
    land(scratch + "/feeds", "https://nobody.example/rss", "r0", item.format("unknown"))
    land(scratch + "/feeds", "https://a.example/rss", "r2", item.format("good"))
    res = C.collect(FD.catalogue(spark, CONFIG), FD.read_landed(spark, scratch + "/feeds"), pages,
                    spark.createDataFrame([], "url string"), NOW, REF)
    got = sorted((r.run_id, r.outcome, r.reason) for r in res.outcomes.collect())
    assert got == [("r0", "rejected", "unknown_feed"), ("r1", "rejected", "title_too_long"), ("r2", "inserted", None)]


def test_semi_join_stands_below_the_parse(spark, scratch):
    pages = landed_pages(spark, scratch)
    states = P.fetch_states(pages, spark.createDataFrame([("https://x.example/1",)], "url string"))
    plan = C.page_fields(pages, REF, states)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("ArrowEvalPython")
    assert "LeftSemi" in below and "html" not in above
    narrow = states._jdf.queryExecution().executedPlan().toString()
    assert "html" not in narrow


def test_semi_join_beyond_the_broadcast_bound(spark, scratch, monkeypatch):
    from newsloom.operators import writes
    pages = landed_pages(spark, scratch, 50)
    keys = pages.select("url").distinct().filter("url LIKE '%7'")
    small = writes.rows_with_keys(pages, keys, ["url"])
    monkeypatch.setattr(writes, "BROADCAST_KEYS", 2)
    large = writes.rows_with_keys(pages, keys, ["url"])
    assert sorted(r.url for r in small.collect()) == sorted(r.url for r in large.collect()) and small.count() == 10
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_stream_works_off_a_backlog_in_bounded_batches(spark, scratch):
    landing, urls = os.path.join(scratch, "landing"), [f"u{i}" for i in range(7)]
    one = "<rss><channel><item><title>t{0}</title><link>u{0}</link></item></channel></rss>"
    cfg = {"sources": {"S": {"feeds": [{"url": f"https://f/{i}"} for i in range(7)]}}}
    for i in range(7):
        land(landing, f"https://f/{i}", "1", one.format(i))
    store, seen = ArticleTable(spark, "t_bounded", os.path.join(scratch, "store")), []
    q = collect_stream(spark, landing, store, FD.catalogue(spark, cfg), lambda: pages_df(spark, urls), lambda: NOW, lambda: REF,
                       os.path.join(scratch, "ckpt"), lambda counts, epoch: seen.append(sum(r["count"] for r in counts.collect())), max_files=3)
    q.awaitTermination()
    assert seen == [3, 3, 1] and store.read().count() == 7
    with pytest.raises(ValueError):
        collect_stream(spark, landing, store, None, None, None, None, "", max_files=1, max_bytes="1m")


