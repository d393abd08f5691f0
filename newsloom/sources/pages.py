"""Landed page fetches: reachability gate and field extraction."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import dates as D
from newsloom.functions.html import parse_page
from newsloom.functions.times import ntz
from newsloom.operators.writes import rows_with_keys


def fetch_ok() -> Column:
    return F.col("fetch_error").isNull() & F.coalesce(F.col("http_status") < 400, F.lit(False))


def reject_reason() -> Column:
    return (F.when(F.col("_has_page").isNull(), F.lit("no_page"))
             .when(F.col("fetch_error").isNotNull(), F.lit("fetch_error"))
             .when(F.col("http_status").isNull(), F.lit("no_status"))
             .when(F.col("http_status") >= 400,
                   F.concat(F.lit("http_"), F.col("http_status").cast("string"))))


def latest_fetch(pages: DataFrame, key: str = "url", by: str = "fetched_at") -> DataFrame:
    """One row per ``key``: the latest landed fetch (``by``; without such a
    column, or on a tie, the largest of the remaining values). Combined in
    every task before the shuffle."""
    rest = [c for c in pages.columns if c not in (key, by)]
    front = [F.col(by)] if by in pages.columns else []
    last = pages.groupBy(key).agg(F.max(F.struct(*front, *[F.col(c) for c in rest])).alias("_last"))
    return last.select(key, "_last.*").select(*pages.columns)


def _fetch_keys(pages: DataFrame) -> list[str]:
    """Columns that tell the fetches of a url apart."""
    return [c for c in ("fetched_at", "http_status", "fetch_error") if c in pages.columns]


def fetch_states(pages: DataFrame, urls: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """State of the latest fetch of each of ``urls`` (one column ``url``):
    the fetch's own columns, ``reachable`` and ``page_reason``. Only the
    narrow columns of the landed pages are read. ``counted``: see
    :func:`rows_with_keys`."""
    keys = _fetch_keys(pages)
    last = latest_fetch(rows_with_keys(pages.select("url", *keys), urls, ["url"], counted))
    return (last.withColumn("_has_page", F.lit(True)).withColumn("page_reason", reject_reason())
            .select("url", *keys, F.col("page_reason").isNull().alias("reachable"), "page_reason"))


def pages_to_parse(pages: DataFrame, states: DataFrame) -> DataFrame:
    """The landed fetches that ``states`` names and that answered: a semi-join
    below the parse, so that pages nobody asked for, earlier fetches and
    failed ones are not parsed."""
    keys = _fetch_keys(states)
    return rows_with_keys(pages, states.filter("reachable").select("url", *keys), ["url", *keys])


def reachability(entries: DataFrame, pages: DataFrame, key: str = "url",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """Entries joined to the latest fetch of their page, with ``reachable``
    and a ``reason`` for the rest (a missing page row is a reject).
    ``carry``: more page columns to bring along in the same join; carry
    extracted fields, not ``html``."""
    wanted = [key, "http_status", "fetch_error", *carry, *[c for c in ("fetched_at",) if c in pages.columns]]
    p = latest_fetch(pages.select(*wanted), key).drop("fetched_at").withColumn("_has_page", F.lit(True))
    j = entries.join(p, key, "left").withColumn("reason", reject_reason())
    return j.withColumn("reachable", F.col("reason").isNull()).drop("_has_page")


def split_reachable(entries: DataFrame, pages: DataFrame, key: str = "url"):
    gated = reachability(entries, pages, key)
    return gated.filter("reachable"), gated.filter(~F.col("reachable"))


def with_page_fields(df: DataFrame, html: str = "html") -> DataFrame:
    """Parse each page once into ``page`` (struct)."""
    return df.withColumn("page", parse_page(F.col(html)))


def extract_fields(df: DataFrame, ref_date, url: str = "url") -> DataFrame:
    """Columns the pipelines use, read from the parsed ``page`` struct in a
    projection after it (one parse per page):
    ``date_raw, published_day, bad_date, image_url, site_name, page_title, text``."""
    pf = F.col("page")
    # Three projections: fields of the struct, then the digit-normalised
    # date text (computed once, read by every native pattern), then the day.
    out = df.withColumns({
        "date_raw": D.page_date_text(pf),
        "image_url": pf["og_image"],
        "site_name": site_name(pf["og_site_name"], F.col(url)),
        "page_title": pf["title"],
        "text": pf["text"],
    })
    out = out.withColumn("_date_ascii", D.ascii_digits(F.col("date_raw")))
    return out.withColumns({
        "published_day": D.resolve_day(F.col("date_raw"), ref_date, F.col("_date_ascii")),
        "bad_date": D.bad_day(F.col("date_raw")),
    }).drop("_date_ascii")


def host_name(url: Column) -> Column:
    """Network location without ``www.``, first letter upper, rest lower."""
    host = F.replace(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("www."), F.lit(""))
    return F.nullif(F.concat(F.upper(F.substring(host, 1, 1)), F.lower(F.substr(host, F.lit(2)))),
                    F.lit(""))


def site_name(og_site_name: Column, url: Column) -> Column:
    """``og:site_name`` when present, else the capitalised host."""
    return F.coalesce(F.nullif(og_site_name, F.lit("")), host_name(url))


def landed_from_table(pages: DataFrame, fetched_at: _dt.datetime) -> DataFrame:
    """Test ``pages`` table to the landed-fetch shape, with a status derived
    from the page number (404, 503 and transport errors mixed in)."""
    n = F.col("page_id") % 10
    return pages.select(
        "page_id", "url", "html",
        F.when(n == 3, F.lit(404)).when(n == 7, F.lit(503)).when(n == 9, F.lit(None))
         .otherwise(F.lit(200)).cast("int").alias("http_status"),
        F.when(n == 9, F.lit("connection reset")).alias("fetch_error"),
        ntz(fetched_at).alias("fetched_at"),
    )
