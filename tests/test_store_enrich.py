"""Article table, insert idempotence, keyed update, pluggable model and
incremental enrich."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from newsloom.operators import writes
from newsloom.plans import enrich as EN
from newsloom.schema import ARTICLE_SCHEMA
from newsloom.sources.store import ArticleTable

NOW = dt.datetime(2026, 12, 1, 6)


def _article(i, url, pending=True):
    return (f"id{i}", f"Title {i}", url, "src", None, None, None, None, None,
            dt.datetime(2026, 1, i % 28 + 1), dt.datetime(2026, 1, i % 28 + 1), not pending)


def test_insert_if_absent_idempotent(spark, scratch):
    store = ArticleTable(spark, "t_insert", scratch + "/t")
    batch = spark.createDataFrame([("u1", 0, "a"), ("u1", 1, "b"), ("u2", 2, "c")],
                                  "url string, pos int, title string")
    first = writes.insert_if_absent(store.read(), batch, "url", order=["pos"])
    assert sorted((r.url, r.title) for r in first.collect()) == [("u1", "a"), ("u2", "c")]
    rows = first.select(writes.article_id(F.col("url")).alias("id"), "title", "url",
                        F.lit("s").alias("source"), *[F.lit(None).cast(f.dataType).alias(f.name)
                                                      for f in ARTICLE_SCHEMA.fields[4:]])
    store.append(rows)
    again = writes.insert_if_absent(store.read(), batch, "url", order=["pos"])
    assert again.count() == 0


def test_keyed_update_sets_empty_array(spark):
    existing = spark.createDataFrame([_article(0, "u0"), _article(1, "u1")], ARTICLE_SCHEMA)
    upd = spark.createDataFrame([("id0", "s", [])], "id string, summary string, tags array<string>")
    out = {r.id: r for r in writes.update_by_key(existing, upd, "id", NOW).collect()}
    assert out["id0"].tags == [] and out["id0"].metadata_generated and out["id0"].updated_at == NOW
    assert out["id1"].tags is None and not out["id1"].metadata_generated
    assert out["id1"].updated_at == dt.datetime(2026, 1, 2)


def _fake_model():
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["text"].str.contains("FAIL")).any():
            raise RuntimeError("model failure")
        return pd.DataFrame({"id": pdf["id"], "summary": "S:" + pdf["text"].str[:5],
                             "tag_text": "トヨタ自動車, 2025年 ,半導体"})
    return run


def test_enrich_with_model_and_retry(spark, scratch):
    store = ArticleTable(spark, "t_enrich", scratch + "/t", parts=4)
    store.append(spark.createDataFrame([_article(0, "u0"), _article(1, "u1"), _article(2, "u2")],
                                       ARTICLE_SCHEMA))
    pages = spark.createDataFrame(
        [("u0", "<p>hello world</p>"), ("u1", "<p>FAIL here</p>"), ("u2", "<p> \n </p>")],
        "url string, html string")
    counts = {r.outcome: r["count"] for r in EN.run_enrich(store, pages, NOW, _fake_model).collect()}
    assert counts == {"updated": 1, "skipped": 2}
    rows = {r.id: r for r in store.read().collect()}
    assert rows["id0"].summary == "S:hello" and rows["id0"].content == "helloworld"
    assert rows["id0"].tags == ["トヨタ", "2025", "半導体"] and rows["id0"].metadata_generated
    assert not rows["id1"].metadata_generated and not rows["id2"].metadata_generated
    # Next run: only the still-pending rows are worked on.
    fixed = pages.withColumn("html", F.when(F.col("url") == "u1", F.lit("<p>ok now</p>"))
                             .otherwise(F.col("html")))
    counts = {r.outcome: r["count"] for r in EN.run_enrich(store, fixed, NOW, _fake_model).collect()}
    assert counts == {"updated": 1, "skipped": 1}
    assert store.read().count() == 3


def test_default_enrichment(spark):
    a = spark.createDataFrame([_article(0, "u0")], ARTICLE_SCHEMA)
    pages = spark.createDataFrame([("u0", "<title>Title 0</title><p>Title words first. Other text here!</p>")],
                                  "url string, html string")
    res = EN.enrich(a, pages)
    r = res.updates.first()
    assert "0Title" not in r.summary and r.content.startswith("Title0Titlewords")
    assert r.tags and all(isinstance(t, str) for t in r.tags)


def _counting_model(folder):
    def make():
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            import os
            import uuid
            for i in pdf["id"]:
                open(os.path.join(folder, f"{i}-{uuid.uuid4().hex}"), "w").close()
            return pd.DataFrame({"id": pdf["id"], "summary": "S", "tag_text": "a"})
        return run
    return make


def test_model_sees_every_article_once(spark, scratch):
    import os
    store = ArticleTable(spark, "t_once", scratch + "/t", parts=4)
    store.append(spark.createDataFrame([_article(i, f"u{i}") for i in range(20)], ARTICLE_SCHEMA))
    pages = spark.createDataFrame([(f"u{i}", f"<p>text {i}</p>") for i in range(20)], "url string, html string")
    os.makedirs(scratch + "/calls")
    counts = {r.outcome: r["count"] for r in EN.run_enrich(store, pages, NOW, _counting_model(scratch + "/calls")).collect()}
    assert counts == {"updated": 20}
    seen = [f.split("-")[0] for f in os.listdir(scratch + "/calls")]
    assert sorted(seen) == sorted(f"id{i}" for i in range(20))


def test_one_pending_page_is_tagged_by_the_whole_corpus(spark):
    """Tags of a row don't depend on what else is pending."""
    rows = [_article(i, f"u{i}") for i in range(6)]
    html = ["<p>about again another common words here about</p>"] * 5 + ["<p>about again zebra zebra crossing</p>"]
    pages = spark.createDataFrame([(f"u{i}", h) for i, h in enumerate(html)], "url string, html string")
    alone = EN.enrich(spark.createDataFrame(rows[5:], ARTICLE_SCHEMA), pages).updates.first()
    among = {r.id: r for r in EN.enrich(spark.createDataFrame(rows, ARTICLE_SCHEMA), pages).updates.collect()}["id5"]
    assert alone.tags == among.tags and alone.tags[0] == "zebra"


def test_terms_are_runs_of_one_script(spark):
    from newsloom.operators import keywords as KW
    df = spark.createDataFrame([("d", "トヨタ自動車は半導体の新工場を建設すると発表した new plant")], "id string, text string")
    got = {r.term for r in KW.term_counts(df, "id", "text").collect()}
    assert got == {"トヨタ", "自動車", "半導体", "新工場", "建設", "発表", "new", "plant"}


def test_stored_normalise_and_cleanup(spark, scratch):
    from newsloom.plans import maintenance as M
    names = ["ITmedia NEWS"] * 3 + ["ITmedia"] * 2 + ["マイナビニュース"] + ["TECH+"] * 2 + ["GIGAZINE"]
    rows = [_article(i, f"u{i}")[:3] + (s,) + _article(i, f"u{i}")[4:] for i, s in enumerate(names)]
    store = ArticleTable(spark, "t_maint", scratch + "/t", parts=4)
    store.append(spark.createDataFrame(rows, ARTICLE_SCHEMA))
    run = M.run_normalise(store, "default", NOW)
    assert [tuple(r) for r in run.before.collect()] == [
        ("GIGAZINE", 1), ("ITmedia", 2), ("ITmedia NEWS", 3), ("TECH+", 2), ("マイナビニュース", 1)]
    after = [("GIGAZINE", 1), ("ITmedia", 5), ("マイナビ Tech+", 2)]
    assert [tuple(r) for r in run.after.collect()] == after
    assert {r.match: r.rows for r in run.steps.collect() if r.rows} == {"マイナビニュース": 1, "ITmedia%": 3, "TECH+%": 2}
    assert sorted(tuple(r) for r in store.read().groupBy("source").count().collect()) == sorted(after)
    store.append(spark.createDataFrame([("id50", "t", "u50", "ITmedia NEWS", *[None] * 8)], ARTICLE_SCHEMA))
    res = M.run_cleanup(store)
    assert (res.preview_total, res.deleted) == (1, 1) and store.read().count() == 8
    assert M.run_cleanup(store).deleted == 0
