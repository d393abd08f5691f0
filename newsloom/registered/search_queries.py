"""Search, paging, facets and display queries over the article table."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsloom.checkout import sql_arr, sql_day, sql_ts
from newsloom.functions import display as D
from newsloom.operators import facets, paging, projections, search
from newsloom.plans.search import search_page
from newsloom.registered.base import (LISTING_ORDER_ASC_SQL, LISTING_ORDER_SQL,
                                      ROW_COLS_SQL, tag_hit_sql, title_hit_sql,
                                      with_articles)
from newsloom.registry import register
from newsloom.sources.tables import articles


def _a(spark, sf):
    return articles(spark, sf)


@register("p1_article_rows", with_articles(f"SELECT {ROW_COLS_SQL} FROM articles"))
def p1_article_rows(spark, sf):
    """Full 12-column article rows."""
    return projections.article_row(_a(spark, sf))


@register("f1_source_eq", with_articles(
    "SELECT id, title, source FROM articles WHERE source = 'src3'"))
def f1_source_eq(spark, sf):
    return search.search(_a(spark, sf), source="src3").select("id", "title", "source")


@register("f2_tag_contains", with_articles(
    f"SELECT id, {sql_arr('tags')} AS tags FROM articles WHERE {tag_hit_sql('%ion%')}"))
def f2_tag_contains(spark, sf):
    return search.search(_a(spark, sf), tag="ion").select("id", "tags")


@register("f3_keyword", with_articles(
    f"SELECT id, title FROM articles WHERE {title_hit_sql('%the%')} OR {tag_hit_sql('%the%')}"))
def f3_keyword(spark, sf):
    return search.search(_a(spark, sf), q="the").select("id", "title")


@register("f4_day", with_articles(
    f"SELECT id, {sql_ts('published_date')} AS published_date FROM articles "
    "WHERE CAST(published_date AS DATE) = DATE '2024-01-05'"))
def f4_day(spark, sf):
    return search.search(_a(spark, sf), date="2024-01-05").select("id", "published_date")


@register("f5_lookup", with_articles(
    f"SELECT {ROW_COLS_SQL} FROM articles WHERE id = 'a-000000000042'"))
def f5_lookup(spark, sf):
    return search.by_id(_a(spark, sf), "a-000000000042")


@register("f6_pending", with_articles(
    "SELECT id, title FROM articles WHERE metadata_generated = FALSE"))
def f6_pending(spark, sf):
    return search.pending(_a(spark, sf)).select("id", "title")


@register("f7_combined", with_articles(
    f"SELECT id, title, source, {sql_ts('published_date')} AS published_date FROM articles "
    "WHERE source = 'src2' AND CAST(published_date AS DATE) = DATE '2024-01-03' "
    f"AND ({title_hit_sql('%a%')} OR {tag_hit_sql('%a%')})"))
def f7_combined(spark, sf):
    """Optional filters: empty tag and None values add nothing."""
    return (search.search(_a(spark, sf), source="src2", tag="", q="a", date="2024-01-03",
                          tags=None)
            .select("id", "title", "source", "published_date"))


@register("f8_source_in", with_articles(
    "SELECT id, source FROM articles WHERE source IN ('src1', 'src5', 'src7')"))
def f8_source_in(spark, sf):
    return _a(spark, sf).filter(search.source_in(["src1", "src5", "src7"])).select("id", "source")


@register("f9_prefix_except", with_articles(
    "SELECT id, source FROM articles WHERE source LIKE 'src1%' AND source <> 'src1'"))
def f9_prefix_except(spark, sf):
    return _a(spark, sf).filter(search.prefix_except("src1%", "src1")).select("id", "source")


@register("f12_tags_any", with_articles(
    f"SELECT id FROM articles WHERE {tag_hit_sql('%ion%')} OR {tag_hit_sql('%the%')}"))
def f12_tags_any(spark, sf):
    return search.search(_a(spark, sf), tags=["ion", "the"], tags_mode="any").select("id")


@register("f12_tags_all", with_articles(
    f"SELECT id FROM articles WHERE {tag_hit_sql('%ion%')} AND {tag_hit_sql('%the%')}"))
def f12_tags_all(spark, sf):
    return search.search(_a(spark, sf), tags=["ion", "the"], tags_mode="all").select("id")


def _paged_sql(where: str, limit: int, offset: int, order: str = LISTING_ORDER_SQL) -> str:
    return with_articles(
        f"SELECT {ROW_COLS_SQL}, pos FROM ("
        f"  SELECT *, {offset} + row_number() OVER (ORDER BY {order}) AS pos FROM ("
        f"    SELECT * FROM articles WHERE {where} ORDER BY {order} LIMIT {limit} OFFSET {offset}"
        f"  ) s"
        f") t")


@register("t1_listing_first_page", _paged_sql("TRUE", 100, 0))
def t1_listing_first_page(spark, sf):
    """Listing order, first page, with 1-based positions."""
    return paging.page(projections.article_row(_a(spark, sf)), 100, 0)


@register("t3_offset_page", _paged_sql("TRUE", 100, 100))
def t3_offset_page(spark, sf):
    return paging.page(projections.article_row(_a(spark, sf)), 100, 100)


@register("t4_keyset_page", _paged_sql("TRUE", 100, 100))
def t4_keyset_page(spark, sf):
    """Second page by keyset: same rows as the offset page."""
    a = projections.article_row(_a(spark, sf))
    keys = paging.listing_keys()
    first = paging.page(a, 100, 0, keys, position=False)
    cursor = paging.cursor_of(first, keys)
    nxt = paging.keyset_page(a, cursor, 100, keys)
    return paging.with_position(nxt, keys, 100)


@register("t5_ascending_page", _paged_sql("TRUE", 100, 0, LISTING_ORDER_ASC_SQL))
def t5_ascending_page(spark, sf):
    keys = paging.listing_keys("asc")
    return paging.page(projections.article_row(_a(spark, sf)), 100, 0, keys)


@register("t2_worklist", with_articles(
    "SELECT id, title, url, content FROM articles WHERE metadata_generated = FALSE"))
def t2_worklist(spark, sf):
    """Pending rows, newest insert first (no limit, as the job runs it)."""
    return projections.worklist_row(
        paging.order(search.pending(_a(spark, sf)), paging.worklist_keys()))


_KW = f"({title_hit_sql('%the%')} OR {tag_hit_sql('%the%')})"


@register("s9_page_meta", with_articles(
    "SELECT count(*) AS n_rows, count(*) = 100 AS has_more, 100 + count(*) AS next_offset FROM ("
    f"SELECT id FROM articles WHERE {_KW} ORDER BY {LISTING_ORDER_SQL} LIMIT 100 OFFSET 100) s"))
def s9_page_meta(spark, sf):
    _, meta = search_page(_a(spark, sf), q="the", limit=100, offset=100)
    return meta


@register("s9_exact_has_more", with_articles(
    "SELECT least(count(*), 100) AS n_rows, count(*) > 100 AS has_more, "
    "0 + least(count(*), 100) AS next_offset FROM ("
    f"SELECT id FROM articles WHERE source = 'src3' ORDER BY {LISTING_ORDER_SQL} LIMIT 101) s"))
def s9_exact_has_more(spark, sf):
    hits = search.search(_a(spark, sf), source="src3")
    return paging.exact_has_more(hits, 100, 0)


_CARD_SQL = (
    "SELECT id, title, url, source, image_url, "
    "coalesce(nullif(summary, ''), 'article.noSummary') AS summary_text, "
    "array_to_string(list_transform(list_slice(tags, 1, 3), lambda t: '#' || t), '|') AS card_tags, "
    "coalesce(strftime(published_date, '{fmt}'), '{none}') AS date_text")


@register("c3_search_page", with_articles(
    _CARD_SQL.format(fmt="%Y/%m/%d", none="公開日") + ", pos FROM ("
    f"  SELECT *, 100 + row_number() OVER (ORDER BY {LISTING_ORDER_SQL}) AS pos FROM ("
    f"    SELECT * FROM articles WHERE {_KW} ORDER BY {LISTING_ORDER_SQL} LIMIT 100 OFFSET 100"
    "  ) s) t"))
def c3_search_page(spark, sf):
    """Flagship: keyword search, listing order, second page, card view."""
    rows, _ = search_page(_a(spark, sf), q="the", limit=100, offset=100, view="card")
    return rows


@register("p2_card_view_ja", with_articles(
    _CARD_SQL.format(fmt="%Y/%m/%d", none="公開日") + " FROM articles"))
def p2_card_view_ja(spark, sf):
    return projections.card_view(_a(spark, sf), "ja")


@register("p2_card_view_en", with_articles(
    _CARD_SQL.format(fmt="%m/%d/%Y", none="Published on") + " FROM articles"))
def p2_card_view_en(spark, sf):
    return projections.card_view(_a(spark, sf), "en")


@register("p3_detail_view", with_articles(
    f"SELECT id, title, url, source, image_url, {sql_arr('tags')} AS tags, "
    "coalesce(CAST(year(published_date) AS VARCHAR) || '年' || CAST(month(published_date) AS VARCHAR)"
    " || '月' || CAST(day(published_date) AS VARCHAR) || '日', '日付不明') AS date_text, "
    "nullif(summary, '') AS summary, nullif(content, '') AS content FROM articles"))
def p3_detail_view(spark, sf):
    return projections.detail_view(_a(spark, sf))


@register("p4_worklist_row", with_articles(
    "SELECT id, title, url, content FROM articles"))
def p4_worklist_row(spark, sf):
    return projections.worklist_row(_a(spark, sf))


@register("x14_day", with_articles(
    f"SELECT id, {sql_day('CAST(published_date AS DATE)')} AS day FROM articles"))
def x14_day(spark, sf):
    return _a(spark, sf).select("id", D.day("published_date").alias("day"))


@register("x16_first_tags", with_articles(
    "SELECT id, array_to_string(list_transform(list_slice(tags, 1, 3), lambda t: '#' || t), '|') "
    "AS card_tags FROM articles"))
def x16_first_tags(spark, sf):
    return _a(spark, sf).select("id", D.first_tags("tags").alias("card_tags"))


@register("x17_summary_fallback", with_articles(
    "SELECT id, coalesce(nullif(summary, ''), 'article.noSummary') AS summary_text FROM articles"))
def x17_summary_fallback(spark, sf):
    return _a(spark, sf).select("id", D.summary_or("summary").alias("summary_text"))


@register("x18_wildcard_search", with_articles(
    f"SELECT id, title FROM articles WHERE {title_hit_sql('%e_u%')} OR {tag_hit_sql('%e_u%')}"))
def x18_wildcard_search(spark, sf):
    """``_`` typed by the user stays a one-character wildcard."""
    return search.search(_a(spark, sf), q="e_u").select("id", "title")


@register("x18_backslash_search", with_articles(
    f"SELECT id, title FROM articles WHERE {title_hit_sql('%th%')} OR {tag_hit_sql('%th%')}"))
def x18_backslash_search(spark, sf):
    """``t\\h``: a backslash before an ordinary letter means the letter."""
    return search.search(_a(spark, sf), q="t\\h").select("id", "title")


@register("x18_literal_search", with_articles(
    "SELECT id, title FROM articles WHERE contains(lower(title), '%%%') "
    "OR coalesce(len(list_filter(tags, lambda t: contains(lower(t), '%%%'))) > 0, false)"))
def x18_literal_search(spark, sf):
    return search.search(_a(spark, sf), q="%%%", literal=True).select("id", "title")


@register("a5_sources", with_articles(
    "SELECT DISTINCT source FROM articles WHERE source IS NOT NULL"))
def a5_sources(spark, sf):
    return facets.distinct_sources(_a(spark, sf))


@register("a6_tags", with_articles(
    "SELECT DISTINCT t AS tag FROM articles, unnest(tags) AS u(t) WHERE tags IS NOT NULL"))
def a6_tags(spark, sf):
    return facets.distinct_tags(_a(spark, sf))
