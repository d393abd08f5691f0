"""Facets kept as signed counts, and the postings of titles and tags, against
the plain queries after inserts, updates, deletes and rule runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from newsloom.operators import facets, search
from newsloom.operators import postings as PO
from newsloom.plans import maintenance as M
from newsloom.plans import search as SP
from newsloom.schema import ARTICLE_SCHEMA
from newsloom.sources.store import ArticleTable
from tests.test_store_layout import read_figures

NOW = dt.datetime(2026, 12, 1, 6)
TAGS = [["AI", "半導体"], ["半導体", "半導体", None], [], None, ["Open%Source", "b_c"], ["ab"], ["GIGAZINE"], ["ai chips"]]
SOURCES = ["ITmedia NEWS", "ITmedia", "TECH+", "GIGAZINE", "マイナビニュース"]


def article(i, tags, pending=False):
    day = None if i % 9 == 0 else dt.datetime(2020 + i % 5, i % 12 + 1, 1)
    return (f"id{i:04d}", f"Title {i} about {['Chips', 'Ｗｉｄｅ', 'the 100% case', 'a\\\\b'][i % 4]}", f"u{i}", SOURCES[i % 5], None, None, day,
            None, tags, NOW, NOW, not pending)


def assert_views(store):
    rows = store.read()
    want = lambda df: [tuple(r) for r in df.collect()]
    assert want(SP.stored_sources(store)) == want(facets.distinct_sources(rows))
    assert want(SP.stored_tags(store)) == want(facets.distinct_tags(rows))
    for order in ("count", "source"):
        assert want(SP.stored_source_counts(store, order)) == want(facets.source_counts(rows, order))
    assert sorted(want(store.days()), key=str) == sorted(
        want(rows.groupBy(F.to_date("published_date")).count()), key=str)


def test_facets_follow_every_write(spark, scratch):
    store = ArticleTable(spark, "t_facets", scratch + "/t", parts=4)
    assert_views(store)
    store.append(spark.createDataFrame([article(i, TAGS[i % 8], i % 3 == 0) for i in range(48)], ARTICLE_SCHEMA))
    assert_views(store)
    upd = spark.createDataFrame([("id0000", ["new tag"]), ("id0003", []), ("id0004", None), ("id0006", ["AI", None])], "id string, tags array<string>")
    store.update(upd, NOW)
    assert_views(store)
    assert "new tag" in {r.tag for r in SP.stored_tags(store).collect()}
    store.update(spark.createDataFrame([("id0000", ["AI"])], "id string, tags array<string>"), NOW)
    assert "new tag" not in {r.tag for r in SP.stored_tags(store).collect()}
    M.run_normalise(store, "default", NOW)
    assert_views(store)
    store.append(spark.createDataFrame([article(100, ["late"])], ARTICLE_SCHEMA))
    M.run_cleanup(store, ["GIGAZINE"])
    assert_views(store)
    store._counts(store.read()).write.insertInto(store._tables(store._version())[2])    # a wrong table is made right
    store._note({"step": "move", "months": []})
    store.settle()
    assert_views(store)


def test_facets_don_t_read_the_rows(spark, scratch):
    store = ArticleTable(spark, "t_facet_plan", scratch + "/t", parts=4)
    store.append(spark.createDataFrame([article(i, ["x"]) for i in range(5)], ARTICLE_SCHEMA))
    plan = SP.stored_tags(store)._jdf.queryExecution().executedPlan().toString()
    assert "t_facet_plan_v1_counts" in plan and "title" not in plan


SEARCHES = [dict(tag="半導体"), dict(tag="Open%Sou"), dict(tag="OPEN\\%source"), dict(tag="b_c"), dict(tag="b_c", literal=True),
            dict(q="chips"), dict(q="ｗｉｄｅ"), dict(q="100%"), dict(q="100%", literal=True), dict(q="a\\\\b"), dict(q="a\\bout"),
            dict(q="about"), dict(q="ai"), dict(q="zzz"), dict(tag="ai", q="title"), dict(tags=["半導体", "ai chips"]),
            dict(tags=["半導体", "AI"], tags_mode="all"), dict(tags=["GIGA", "chip"], tags_mode="all"), dict(q="title 1", source="ITmedia"),
            dict(q="title", date="2021-02-01"), dict(date="2021-02-01"), dict(), dict(q=""), dict(tags=["", "new tag"]), dict(q="t_t%e 4")]


def test_postings_find_what_the_scan_finds(spark, scratch):
    store = ArticleTable(spark, "t_index", scratch + "/t", parts=4, indexed=True)
    store.append(spark.createDataFrame([article(i, TAGS[i % 8], i % 3 == 0) for i in range(48)], ARTICLE_SCHEMA))
    store.update(spark.createDataFrame([("id0000", ["new tag"]), ("id0003", []), ("id0004", None)], "id string, tags array<string>"), NOW)
    for given in SEARCHES:
        got = sorted(r.id for r in SP.stored_search(store, **given).collect())
        assert got == sorted(r.id for r in search.search(store.read(), **given).collect()), given
    M.run_cleanup(store, ["GIGAZINE"])
    assert sorted(r.id for r in SP.stored_search(store, q="chips").collect()) == sorted(
        r.id for r in search.search(store.read(), q="chips").collect())


def test_search_reads_candidates_only(spark, scratch):
    store = ArticleTable(spark, "t_candidates", scratch + "/t", parts=4, indexed=True)
    rows = [article(i, None) for i in range(60)] + [article(61, ["needle in hay"]), article(62, ["needle"])]
    store.append(spark.createDataFrame(rows, ARTICLE_SCHEMA))
    hit = SP.stored_search(store, tag="needle")
    assert {r.id for r in hit.collect()} == {"id0061", "id0062"}
    assert read_figures(hit)[1] == 2 < read_figures(store.read())[1]
    index = PO.candidates(store.postings(), PO.pattern_grams(spark, "needle"), (PO.TAG,))
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount" in plan or index.count() == 2
    plain = ArticleTable(spark, "t_plain", scratch + "/p", parts=4)
    with pytest.raises(ValueError):
        plain.postings()


def test_grams(spark):
    df = spark.createDataFrame([("ABCab",), ("ab",), ("",), (None,), ("半導体工",)], "s string")
    got = [sorted(r.g) for r in df.select(PO.grams(F.col("s")).alias("g")).collect()]
    assert got == [["abc", "bca", "cab"], [], [], [], ["半導体", "導体工"]]
    assert PO.pattern_grams(spark, "a%bcd_") == ["bcd"] and PO.pattern_grams(spark, "ab%c") == []
