"""Page extraction, date resolution and reachability queries."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from newsloom.checkout import sql_day
from newsloom.functions import dates as D
from newsloom.functions import text as X
from newsloom.functions.html import INLINE_TAGS
from newsloom.registered.base import ARTICLES_CTE
from newsloom.registry import register
from newsloom.sources import pages as P
from newsloom.sources.tables import articles, orders_pages, read_table

REF = _dt.date(2026, 12, 1)
FETCHED = _dt.datetime(2026, 12, 1, 5, 0, 0)

_UNICODE_SPACE_RE2 = X.UNICODE_SPACE  # same syntax in RE2 and Java


def _strip_sql(expr: str) -> str:
    return (f"regexp_replace({expr}, '^{_UNICODE_SPACE_RE2}+|{_UNICODE_SPACE_RE2}+$', '', 'g')")


def _squeeze_sql(expr: str) -> str:
    return _strip_sql(f"translate({expr}, chr(10) || chr(9) || chr(13) || ' ', '')")


# Text of the generated test pages by regular expressions: drop scripts,
# styles, comments and declarations, then tags, then decode the four entities
# those pages use. A trailing semicolon is optional (some generated titles are
# cut inside an entity, and HTML decodes ``&amp`` without one); ``&amp`` goes
# last, in one pass, so decoding never creates a new entity.
def _decode_sql(expr: str) -> str:
    out = expr
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        out = f"regexp_replace({out}, '&{name};?', '{char}', 'g')"
    return out


_PAGE_TEXT_SQL = _decode_sql("""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
    '(?s)<script[^>]*>.*?</script>', '', 'g'),
    '(?s)<style[^>]*>.*?</style>', '', 'g'),
    '(?s)<!--.*?-->', '', 'g'),
    '<![^>]*>', '', 'g'),
    '<[^>]+>', '', 'g')""")


_INLINE_RE2 = "(?i)</?(?:" + "|".join(sorted(INLINE_TAGS)) + r")(?:\\s[^>]*)?/?>"

# The same with a line end in the place of every element that is not inline.
_BLOCKS_SQL = "regexp_replace(regexp_replace(" + _decode_sql(f"""regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(html,
    '(?s)<script[^>]*>.*?</script>', chr(10), 'g'),
    '(?s)<style[^>]*>.*?</style>', chr(10), 'g'),
    '(?s)<!--.*?-->', '', 'g'),
    '<![^>]*>', '', 'g'),
    '{_INLINE_RE2}', '', 'g'),
    '<[^>]+>', chr(10), 'g')""") + ", '\\n{2,}', chr(10), 'g'), '^\\n|\\n$', '', 'g')"


def _pages(spark, sf):
    return read_table(spark, sf, "pages", spread_out=True)


def _parsed_pages(spark, sf):
    return P.with_page_fields(_pages(spark, sf))


@register("x8_page_text", f"SELECT page_id, {_PAGE_TEXT_SQL} AS text FROM pages")
def x8_page_text(spark, sf):
    """All page text in document order (no scripts, styles or comments)."""
    return _parsed_pages(spark, sf).select("page_id", F.col("page")["text"].alias("text"))


@register("x8_page_blocks", f"SELECT page_id, {_BLOCKS_SQL} AS text FROM pages")
def x8_page_blocks(spark, sf):
    """The same text with its blocks separated (what the analysis reads)."""
    return _parsed_pages(spark, sf).select("page_id", F.col("page")["blocks"].alias("text"))


@register("x9_squeezed_page_text", f"SELECT page_id, {_squeeze_sql(_PAGE_TEXT_SQL)} AS text FROM pages")
def x9_squeezed_page_text(spark, sf):
    return _parsed_pages(spark, sf).select("page_id", X.squeeze(F.col("page")["text"]).alias("text"))


@register("x9_squeeze_documents", f"SELECT doc_id, {_squeeze_sql('text')} AS text FROM documents")
def x9_squeeze_documents(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", X.squeeze("text").alias("text"))


_TITLE_SQL = _decode_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")


@register("k1_page_titles", f"SELECT page_id, {_TITLE_SQL} AS title FROM pages")
def k1_page_titles(spark, sf):
    return _parsed_pages(spark, sf).select("page_id", F.col("page")["title"].alias("title"))


_HOST_SQL = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"


@register("x11_site_name",
          f"SELECT page_id, nullif(upper(substr(replace({_HOST_SQL}, 'www.', ''), 1, 1)) || "
          f"lower(substr(replace({_HOST_SQL}, 'www.', ''), 2)), '') AS site_name FROM pages")
def x11_site_name(spark, sf):
    pp = _parsed_pages(spark, sf)
    return pp.select("page_id", P.site_name(F.col("page")["og_site_name"], F.col("url")).alias("site_name"))


@register("s3_reachability", "WITH " + ARTICLES_CTE + """,
st AS (SELECT url, CASE page_id % 10 WHEN 3 THEN 404 WHEN 7 THEN 503 WHEN 9 THEN NULL ELSE 200 END AS http_status,
              CASE WHEN page_id % 10 = 9 THEN 'connection reset' END AS fetch_error FROM pages)
SELECT a.id, a.url,
  CASE WHEN st.url IS NULL THEN 'no_page' WHEN st.fetch_error IS NOT NULL THEN 'fetch_error'
       WHEN st.http_status IS NULL THEN 'no_status'
       WHEN st.http_status >= 400 THEN 'http_' || CAST(st.http_status AS VARCHAR) END AS reason,
  (st.url IS NOT NULL AND st.fetch_error IS NULL AND st.http_status < 400) AS reachable
FROM articles a LEFT JOIN st ON st.url = a.url""")
def s3_reachability(spark, sf):
    entries = articles(spark, sf).select("id", "url")
    landed = P.landed_from_table(_pages(spark, sf), FETCHED)
    return P.reachability(entries, landed).select("id", "url", "reason", "reachable")


_EXPECTED_DAY = f"CASE WHEN o_orderkey % 6 < 4 THEN {sql_day('o_orderdate')} END"


@register("x5_iso_check", "SELECT o_orderkey, o_orderkey % 6 = 0 AS is_iso FROM orders")
def x5_iso_check(spark, sf):
    return orders_pages(spark, sf).select("o_orderkey", D.is_iso_day("date_string").alias("is_iso"))


@register("x6_native_day", f"SELECT o_orderkey, {_EXPECTED_DAY} AS day FROM orders")
def x6_native_day(spark, sf):
    """Free-text day from the four written formats, built-in expressions only."""
    return orders_pages(spark, sf).select("o_orderkey", D.native_day("date_string").alias("day"))


# Each order's day, written in one of these ways by order number: date formats
# with text before and after (``{era}``: year of the Heisei era).
SPELLINGS = (
    ("", "d MMM ''yy", ""), ("Published ", "MMM d, yy", " by X"), ("", "yyyy MMM d", ""), ("on ", "MMMM d'th of' yyyy", " at noon"),
    ("", "{era}'年'M'月'd'日'", " 更新"), ("10:15 ", "MMM d yyyy", ""), ("", "yyyyMMdd", ""), ("", "yyyyMMdd'T101500Z'", ""),
    ("updated ", "M/d/yy", ""), ("", "MM-dd-yyyy", ""), ("am ", "M.d.yyyy", " um 9"), ("", "dd-MMM-yyyy", ""), ("", "yyyy-MMM-dd", ""),
    ("", "MMMM 'the' d yyyy", ""), ("", "EEE MMM d", " 10:15:00 {year}"), ("", "EEEE, d MMMM yyyy", " 10:00 GMT"),
    ("", "yyyy.MM.dd", " 18:00"), ("", "yyyy'年'M'月'd'日'", " 10時30分"), ("３ more, ", "yyyy/M/d", " 18:00 更新"),
    ("", "yyyy-MM-dd'T23:30:00'", "+09:00"),
)


@register("x6_date_spellings", "SELECT o_orderkey, " + sql_day("o_orderdate") + " AS day FROM orders")
def x6_date_spellings(spark, sf):
    """Every order's day back from twenty spellings."""
    o = read_table(spark, sf, "orders", spread_out=True)
    d, year = F.col("o_orderdate"), F.date_format("o_orderdate", "yyyy")
    text = F.lit(None).cast("string")
    for i, (before, form, after) in enumerate(SPELLINGS):
        written = (F.concat(F.lit("平成"), (F.year(d) - 1988).cast("string"), F.date_format(d, form.partition("{era}")[2]))
                   if "{era}" in form else F.date_format(d, form))
        tail = F.concat(F.lit(after.partition("{year}")[0]), year) if "{year}" in after else F.lit(after)
        text = F.when(F.col("o_orderkey") % len(SPELLINGS) == i, F.concat(F.lit(before), written, tail)).otherwise(text)
    return o.select("o_orderkey", D.resolve_day(text, REF).alias("day"))


@register("k1_page_dates",
          f"SELECT o_orderkey, {_EXPECTED_DAY} AS published_day, false AS bad_date, "
          "CASE WHEN floor(o_orderkey / 6) % 2 = 0 THEN 'https://img.example.org/o' || "
          "CAST(o_orderkey AS VARCHAR) || '.png' END AS image_url FROM orders")
def k1_page_dates(spark, sf):
    """Parse each constructed page once; date by precedence; og:image."""
    pp = P.with_page_fields(orders_pages(spark, sf, spread_out=True))
    out = P.extract_fields(pp, REF)
    return out.select("o_orderkey", "published_day", "bad_date", "image_url")


@register("k2_residual_dates",
          f"SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN {sql_day('o_orderdate')} "
          f"ELSE {sql_day('date_trunc(' + chr(39) + 'year' + chr(39) + ', o_orderdate)')} END AS day "
          "FROM orders")
def k2_residual_dates(spark, sf):
    """Partial dates the native path cannot solve (day and month only, or a
    relative time) from every order, resolved by the residual parser with the
    first day of the order's year as reference date."""
    o = read_table(spark, sf, "orders", spread_out=True)
    k = F.col("o_orderkey")
    text = F.when(k % 2 == 0, F.concat(F.lit("Posted "), F.date_format("o_orderdate", "d MMM"))) \
            .otherwise(F.lit("updated 3 hours ago"))
    ref = F.trunc(F.to_date("o_orderdate"), "year")
    return o.select("o_orderkey", D.resolve_day(text, ref).alias("day"))
