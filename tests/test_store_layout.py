"""What the stored table's layout saves: partitions and files read and
rewritten, no exchange of its urls, versions and interrupted writers."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from newsloom.operators import paging, writes
from newsloom.plans import enrich as EN
from newsloom.plans import search as SP
from newsloom.schema import ARTICLE_SCHEMA
from newsloom.sources.store import ArticleTable

NOW = dt.datetime(2026, 12, 1, 6)


def article(i, day=None, done=True, url=None):
    made = dt.datetime(2026, 1, 1) + dt.timedelta(seconds=i % 7)
    return (f"id{i:05d}", f"Title {i}", url or f"u{i}", "src", None, None,
            None if day is None else dt.datetime.combine(day, dt.time()), None, None, made, made, done)


def frame(spark, rows):
    return spark.createDataFrame(rows, ARTICLE_SCHEMA)


def months(n):
    return [dt.date(2015 + i // 12, i % 12 + 1, 1) for i in range(n)]


def history(n_months, start=0):
    """Done rows on three days a month, eight a day, and some undated ones."""
    days = [m + dt.timedelta(days=d) for m in months(n_months) for d in (0, 9, 20)]
    return [article(start + 8 * i + k, day) for i, day in enumerate(days) for k in range(8)] + \
        [article(90_000 + k) for k in range(5)]


def files(scratch):
    return set(glob.glob(scratch + "/t/**/*.parquet", recursive=True))


def read_figures(df):
    """(files, partitions) that the scans of the rows' table read."""
    df = df.select("*")          # a plan of its own: figures of a plan that ran before are gone
    df.collect()
    n, parts, todo = 0, 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            n += node.metrics().apply("numFiles").value()
            parts += node.metrics().apply("numPartitions").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return n, parts


def test_enrich_reads_and_rewrites_pending_partitions_only(spark, scratch):
    store = ArticleTable(spark, "t_layout", scratch + "/t", parts=4)
    store.append(frame(spark, history(100) + [article(99_000 + i, dt.date(2024, 5, 1 + i), False) for i in range(4)]))
    assert len(glob.glob(scratch + "/t/t_layout_v1/state=done/month=*")) == 101
    assert read_figures(store.pending())[1] == 1
    before = files(scratch)
    pages = spark.createDataFrame([(f"u{99_000 + i}", f"<p>text {i}</p>") for i in range(3)], "url string, html string")
    counts = {r.outcome: r["count"] for r in EN.run_enrich(store, pages, NOW).collect()}
    assert counts == {"updated": 3, "skipped": 1}
    gone, new = before - files(scratch), files(scratch) - before
    assert gone and all("state=pending/month=2024-05" in f for f in gone)
    assert new and all("month=2024-05" in f or "_counts/" in f for f in new)
    rows = store.read().filter("id >= 'id99'").collect()
    assert sorted((r.id, r.metadata_generated, r.content) for r in rows) == [
        (f"id{99_000 + i}", i < 3, f"text{i}" if i < 3 else None) for i in range(4)]
    assert store.read().count() == 100 * 24 + 5 + 4 and store.pending().count() == 1
    pages = spark.createDataFrame([("u99003", "<p>late</p>")], "url string, html string")
    EN.run_enrich(store, pages, NOW)
    assert store.pending().count() == 0 and store.read().count() == 100 * 24 + 5 + 4
    assert not glob.glob(scratch + "/t/t_layout_v1/state=pending/*/*.parquet")


def test_update_of_done_rows(spark, scratch):
    store = ArticleTable(spark, "t_done", scratch + "/t", parts=4)
    store.append(frame(spark, history(6) + [article(99_000, dt.date(2015, 2, 3), False)]))
    before = files(scratch)
    upd = spark.createDataFrame([("id00001", "a"), ("id99000", "b"), ("id99000", "c"), ("nobody", "d")], "id string, summary string")
    store.update(upd, NOW)
    assert {f.split("/t_done_v1/")[1].rsplit("/", 1)[0] for f in before - files(scratch)} == {
        "state=done/month=2015-01", "state=pending/month=2015-02"}
    rows = {r.id: r for r in store.read().collect()}
    assert len(rows) == store.read().count() == 6 * 24 + 6
    assert rows["id00001"].summary == "a" and rows["id99000"].summary == "b" and rows["id99000"].metadata_generated
    with pytest.raises(ValueError):
        store.update(upd.withColumn("published_date", F.lit(None).cast("timestamp_ntz")), NOW)
    store.update(upd.filter("id = 'nobody'"), NOW)


def test_day_and_deep_pages_read_a_constant_part(spark, scratch):
    """Files read for one day, a deep offset and a deep cursor, with 12 and
    with 96 months stored."""
    figures = []
    for n in (12, 96):
        store = ArticleTable(spark, f"t_deep{n}", f"{scratch}/t{n}", parts=4)
        rows = history(n)
        for part in range(3):                    # several runs, files in every month
            store.append(frame(spark, rows[part::3]))
        day, total = dt.date(2015, 4, 10), len(rows)
        whole = [r.id for r in paging.order(store.read(), paging.listing_keys()).collect()]
        on_day = SP.stored_day(store, day)
        assert on_day.count() == 8
        deep = SP.stored_page(store, 10, total - 60)
        assert [r.id for r in deep.collect()] == whole[total - 60:total - 50]
        last = store.read().filter(F.col("id") == whole[total - 61]).select(*[k.col for k in paging.listing_keys()]).first()
        after = SP.stored_after(store, tuple(last), 10)
        assert [r.id for r in after.collect()] == whole[total - 60:total - 50]
        figures.append([read_figures(df) for df in (on_day, deep, after)])
        # every page, also over the undated end
        assert [r.id for o in range(0, total + 9, 97) for r in SP.stored_page(store, 97, o).collect()] == whole if n == 12 else True
        undated = store.undated().orderBy(*[k.sort() for k in paging.listing_keys()]).select(*[k.col for k in paging.listing_keys()]).first()
        assert [r.id for r in SP.stored_after(store, tuple(undated), 10).collect()] == whole[total - 4:]
        assert SP.stored_page(store, 10, total).count() == 0
    small, large = figures
    assert large == small and all(0 < parts <= 6 for _, parts in large)


def test_url_side_is_not_exchanged(spark, scratch):
    store = ArticleTable(spark, "t_urls", scratch + "/t", parts=8)
    store.append(frame(spark, history(4)))
    store.append(frame(spark, [article(80_000, url="again")]))
    keys = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(0, 5000).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.col("id").alias("pos")) \
            .unionByName(spark.createDataFrame([("again", 1)], "url string, pos long"))
        new = writes.insert_if_absent(store.urls(), batch, "url", order=["pos"])
        assert new.count() == 5000 - 96
        new.collect()
        plan = new._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keys)
    scan = next(i for i, line in enumerate(plan.splitlines()) if "t_urls_v1_urls" in line)
    above = plan.splitlines()[:scan]
    depth = len(plan.splitlines()[scan]) - len(plan.splitlines()[scan].lstrip(" :+-*"))
    path, indent = [], depth
    for line in reversed(above):
        d = len(line) - len(line.lstrip(" :+-*"))
        if d < indent:
            path.append(line)
            indent = d
    below_join = path[:next(i for i, line in enumerate(path) if "SortMergeJoin" in line)]
    assert "Bucketed: true" in plan.splitlines()[scan] or "bucket" in plan.lower()
    assert not any("Exchange" in line for line in below_join), below_join


def test_versions_and_interrupted_writers(spark, scratch, monkeypatch):
    store = ArticleTable(spark, "t_versions", scratch + "/t", parts=4)
    store.append(frame(spark, [article(i, dt.date(2024, 1, 5), i % 2 == 0) for i in range(10)]))
    old = store.read()
    store.replace(store.read().filter("id <> 'id00003'"))
    assert store.read().count() == 9 and store.urls().count() == 9 and old.count() == 10
    assert {(str(r.day), r.n) for r in store.days().collect()} == {("2024-01-05", 9)}
    other = ArticleTable(spark, "t_versions", scratch + "/t", parts=4)
    assert other.read().count() == 9
    # A writer that stops after its rows were added: neither urls nor counts are lost.
    real = ArticleTable._insert_urls
    monkeypatch.setattr(ArticleTable, "_insert_urls", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.append(frame(spark, [article(50, dt.date(2024, 2, 5))]))
    monkeypatch.setattr(ArticleTable, "_insert_urls", real)
    store.append(frame(spark, [article(51)]))
    assert store.read().count() == store.urls().count() == 11 and store.days().agg(F.sum("n")).first()[0] == 11
    # A writer that stops while rows move: readers see each row once, the next writer finishes.
    upd = spark.createDataFrame([("id00001", "s")], "id string, summary string")
    real = ArticleTable._overwrite
    monkeypatch.setattr(ArticleTable, "_overwrite", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        store.update(upd, NOW, pending_only=True)
    monkeypatch.setattr(ArticleTable, "_overwrite", real)
    assert store.read().count() == 11 and store.pending().filter("id = 'id00001'").count() == 0
    store.settle()
    assert store.read().count() == 11 and store._noted() is None
    assert store.read().filter("id = 'id00001'").first().summary == "s"
