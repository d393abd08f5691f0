"""Search page: optional filters, listing order, offset page, envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators import facets, paging, projections, search
from newsloom.operators import postings as PO
from newsloom.session import cut_lineage


def search_page(articles: DataFrame, source=None, tag=None, q=None, date=None,
                limit: int = 100, offset: int = 0, view: str = "row",
                direction: str = "desc", literal: bool = False,
                tags=None, tags_mode: str = "any") -> tuple[DataFrame, DataFrame]:
    """Rows of one page and its one-row envelope (``n_rows, has_more,
    next_offset``). ``view='card'`` projects before the sort so the large
    ``content`` column is never carried through the top-k."""
    hits = search.search(articles, source=source, tag=tag, q=q, date=date,
                         tags=tags, tags_mode=tags_mode, literal=literal)
    keys = paging.listing_keys(direction)
    if view == "card":
        paged = paging.page(hits.drop("content"), limit, offset, keys)
        rows = projections.card_view(paged, keep=("pos",))
    else:
        rows = paging.page(projections.article_row(hits), limit, offset, keys)
    return rows, paging.page_meta(rows, limit, offset)


def stored_page(store, limit: int = 100, offset: int = 0) -> DataFrame:
    """Page of the stored table's whole listing. The counts by day give the
    dates it can hold, so only their partitions and files are read, however
    long the table and deep the offset."""
    span = store.day_range(limit, offset)
    if span is None or limit == 0:
        return paging.page(store.read().limit(0), limit)
    return paging.page(store.between(span["first"], span["last"], span["undated"]) if span["first"]
                       else store.undated(), limit, span["skip"])


def stored_after(store, cursor: tuple, limit: int = 100) -> DataFrame:
    """Rows of the listing behind ``cursor`` (values of the listing keys),
    from the partitions of the days that the next ``limit`` rows can be on."""
    if cursor[0] is None:
        return paging.keyset_page(store.undated(), cursor, limit)
    day = cursor[0].date()
    span = store.day_range(limit, after=day)
    rows = store.between(span["first"] or day, day, span["undated"])
    return paging.keyset_page(rows, cursor, limit)


def stored_day(store, day) -> DataFrame:
    """Rows of one calendar day: one month's partitions, and of those the
    files that hold the day."""
    return store.between(day, day)


def stored_search(store, source=None, tag=None, q=None, date=None, tags=None, tags_mode: str = "any",
                  literal: bool = False) -> DataFrame:
    """:func:`search.search` on an indexed table: the postings give candidate
    rows, only their partitions are read, and the search predicates decide
    them. Filters whose patterns have no gram give no candidates; when none
    has, the rows (of the day, if one is given) are scanned."""
    tags = [t for t in tags or [] if t]
    filters = [([tag], "all", (PO.TAG,)), ([q], "all", (PO.TITLE, PO.TAG)), (tags, tags_mode, (PO.TAG,))]
    found = None
    for patterns, mode, fields in filters:
        wanted = [PO.pattern_grams(store.spark, p, literal) for p in patterns if p]
        if mode == "any" and not all(wanted):
            continue
        each = [PO.candidates(store.postings(), grams, fields) for grams in wanted if grams]
        if not each:
            continue
        keys = each[0]
        for more in each[1:]:
            keys = keys.unionByName(more).distinct() if mode == "any" else keys.join(more, ["id", "month"])
        found = keys if found is None else found.join(keys, ["id", "month"])
    if found is not None:
        rows = store.named(cut_lineage(found))
    elif date is not None and date != "":
        day = search.parse_day(date)
        rows = store.between(day, day)
    else:
        rows = store.read()
    return search.search(rows, source=source, tag=tag, q=q, date=date, tags=tags, tags_mode=tags_mode, literal=literal)


def stored_sources(store) -> DataFrame:
    """Sources in order, from the kept counts."""
    return facets.distinct_sources(store.counts("source").withColumnRenamed("value", "source"))


def stored_tags(store) -> DataFrame:
    """Tags in order, NULL last, from the kept counts."""
    return store.counts("tag").select(F.col("value").alias("tag")).orderBy(F.col("tag").asc_nulls_last())


def stored_source_counts(store, order_by: str = "count") -> DataFrame:
    """Rows per source, from the kept counts."""
    keys = [F.col("count").desc()] if order_by == "count" else []
    return store.counts("source").select(F.col("value").alias("source"), F.col("n").alias("count")).orderBy(
        *keys, F.col("source").asc_nulls_last())
