"""Display expressions for list cards and the detail view."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference UI: labels shown for a missing
# date (card: per language; detail view: Japanese) and the summary fallback
# key the card renders when neither language file defines it.
CARD_NO_DATE = {"ja": "公開日", "en": "Published on"}
DETAIL_NO_DATE = "日付不明"
NO_SUMMARY = "article.noSummary"

_CARD_FORMAT = {"ja": "yyyy/MM/dd", "en": "MM/dd/yyyy"}
_DETAIL_FORMAT = "yyyy年M月d日"


def day(col: str | Column = "published_date") -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(col if isinstance(col, Column) else F.col(col))


def card_date(col: str | Column = "published_date", locale: str = "ja") -> Column:
    c = col if isinstance(col, Column) else F.col(col)
    return F.coalesce(F.date_format(c, _CARD_FORMAT[locale]), F.lit(CARD_NO_DATE[locale]))


def detail_date(col: str | Column = "published_date") -> Column:
    c = col if isinstance(col, Column) else F.col(col)
    return F.coalesce(F.date_format(c, _DETAIL_FORMAT), F.lit(DETAIL_NO_DATE))


def first_tags(col: str | Column = "tags", n: int = 3, prefix: str = "#") -> Column:
    """First ``n`` tags, each prefixed."""
    c = col if isinstance(col, Column) else F.col(col)
    return F.transform(F.slice(c, 1, n), lambda t: F.concat(F.lit(prefix), t))


def summary_or(col: str | Column = "summary", fallback: str = NO_SUMMARY) -> Column:
    c = col if isinstance(col, Column) else F.col(col)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(fallback))


def non_empty(col: str | Column) -> Column:
    """The value when non-empty, else NULL (the detail view hides it)."""
    c = col if isinstance(col, Column) else F.col(col)
    return F.nullif(c, F.lit(""))
