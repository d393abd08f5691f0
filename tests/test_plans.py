"""Plan shape: pushdown, pruning, top-k, map-side combine, no extra shuffles."""

import contextlib
import io
import os

from newsloom.operators import keywords, search, writes
from newsloom.plans.search import search_page
from newsloom.sources.tables import articles, event_batch
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _stored(spark, scratch):
    path = os.path.join(scratch, "articles")
    articles(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


def test_day_filter_pushed_as_range(spark, scratch):
    a = _stored(spark, scratch)
    p = _plan(search.search(a, date="2024-01-05", source="src1"))
    assert "GreaterThanOrEqual(published_date,2024-01-05T00:00)" in p
    assert "LessThan(published_date,2024-01-06T00:00)" in p
    assert "EqualTo(source,src1)" in p


def test_card_page_prunes_content_and_uses_top_k(spark, scratch):
    a = _stored(spark, scratch)
    rows, _ = search_page(a, q="the", limit=100, offset=100, view="card")
    p = _plan(rows)
    assert "TakeOrderedAndProject" in p
    read = [ln for ln in p.splitlines() if ln.startswith("ReadSchema:")]
    assert read and all("content" not in ln for ln in read)


def test_first_per_key_combines_map_side(spark):
    df = writes.first_per_key(event_batch(spark, SF_SMALL), "url", ["entry_ts", "entry_pos"])
    p = _plan(df)
    assert "partial_min" in p


def test_keyword_job_shape(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    terms = keywords.keyword_terms(d, "doc_id", "text")
    terms.collect()
    p = _plan(terms)
    assert "WindowGroupLimit" in p
    assert "partial_count" in p


def test_keyset_bound_is_pushed_and_content_stays_out_of_the_top_k(spark, scratch):
    import datetime as dt

    from newsloom.operators import paging
    a = _stored(spark, scratch)
    nxt = paging.keyset_page(a, (dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 1), "a-1"), 50)
    pushed = [line for line in _plan(nxt).splitlines() if line.startswith("PushedFilters:")]
    assert pushed and all("LessThanOrEqual(published_date,2024-01-09T00:00)" in line for line in pushed)
    for df in (nxt, paging.page(a, 50, 50)):
        tops = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines()
                if "TakeOrderedAndProject" in line or "GlobalLimit" in line]
        assert tops and all("content" not in line for line in tops)


def test_collect_parses_on_the_page_scan(spark, scratch):
    """The parse reads the scan: no exchange below it, and above it only the
    extracted fields."""
    from newsloom.plans.collect import page_fields
    from newsloom.sources.tables import order_feeds
    order_feeds(spark, SF_SMALL)[2].write.parquet(scratch + "/pages")
    plan = page_fields(spark.read.parquet(scratch + "/pages"), None)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("ArrowEvalPython")
    assert "Exchange" not in below and "html" in below and "html" not in above


def test_table_side_of_the_insert_is_neither_shuffled_nor_made_distinct(spark, scratch):
    a = _stored(spark, scratch)
    batch = event_batch(spark, SF_SMALL).limit(5)
    df = writes.insert_if_absent(a, batch, "url", order=["entry_ts", "entry_pos"])
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in p and "LeftSemi" in p


def test_topic_rules_grow_linearly(spark):
    from newsloom.functions import text as X
    d = spark.createDataFrame([(["a"], "text")], "tags array<string>, text string")
    size = lambda n: len(d.select(X.topic_tags("tags", "text", tuple((f"k{i:03d}", f"t{i:03d}") for i in range(n))))
                         ._jdf.queryExecution().analyzed().toString())
    assert size(60) < 3 * size(30)
