"""Search predicates and their optional composition."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.patterns import icontains


def source_is(value: str) -> Column:
    """Exact source equality."""
    return F.col("source") == F.lit(value)


def any_tag_contains(text: str, literal: bool = False, tags: str = "tags") -> Column:
    """Some tag contains ``text`` (case-insensitive). NULL arrays and arrays
    with NULL elements but no hit give FALSE, so the predicate negates
    cleanly."""
    return F.coalesce(F.exists(F.col(tags), lambda t: icontains(t, text, literal)),
                      F.lit(False))


def keyword(text: str, literal: bool = False) -> Column:
    """Title contains ``text`` or some tag does."""
    return F.coalesce(icontains(F.col("title"), text, literal), F.lit(False)) | \
        any_tag_contains(text, literal)


def parse_day(value: str | _dt.date) -> _dt.date:
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(value.strip())


def on_day(value: str | _dt.date, col: str = "published_date") -> Column:
    """Calendar-day equality. Catalyst rewrites ``to_date(ts) = d`` on a
    timestamp_ntz column into a pushed range on the scan."""
    return F.to_date(F.col(col)) == F.lit(parse_day(value))


def tags_match(patterns: list[str], mode: str = "any", literal: bool = False) -> Column:
    """Multi-tag filter: any / all of the patterns hit some tag."""
    preds = [any_tag_contains(p, literal) for p in patterns if p]
    if not preds:
        return F.lit(True)
    if mode == "all":
        return reduce(lambda a, b: a & b, preds)
    if mode == "any":
        return reduce(lambda a, b: a | b, preds)
    raise ValueError(f"mode must be 'any' or 'all', got {mode!r}")


def source_in(values: list[str]) -> Column:
    return F.col("source").isin(list(values))


def prefix_except(pattern: str, exclude: str | None = None, col: str = "source") -> Column:
    """Case-sensitive LIKE, optionally excluding one exact value."""
    pred = F.col(col).like(pattern)
    if exclude is not None:
        pred = pred & (F.col(col) != F.lit(exclude))
    return F.coalesce(pred, F.lit(False))


def _given(v) -> bool:
    if v is None:
        return False
    if isinstance(v, str):
        return v != ""
    if isinstance(v, (list, tuple)):
        return any(_given(x) for x in v)
    return True


def search(df: DataFrame, source: str | None = None, tag: str | None = None,
           q: str | None = None, date: str | _dt.date | None = None,
           tags: list[str] | None = None, tags_mode: str = "any",
           literal: bool = False) -> DataFrame:
    """Conjunction of the given filters; a missing or empty value adds nothing."""
    preds: list[Column] = []
    if _given(source):
        preds.append(source_is(source))
    if _given(tag):
        preds.append(any_tag_contains(tag, literal))
    if _given(q):
        preds.append(keyword(q, literal))
    if _given(date):
        preds.append(on_day(date))
    if _given(tags):
        preds.append(tags_match([t for t in tags if t], tags_mode, literal))
    return reduce(lambda acc, p: acc.filter(p), preds, df)


def by_id(df: DataFrame, article_id: str) -> DataFrame:
    """Zero or one article."""
    return df.filter(F.col("id") == F.lit(article_id)).limit(1)


def pending(df: DataFrame) -> DataFrame:
    """Rows whose metadata is still to be generated (NULL counts as not pending)."""
    return df.filter(F.col("metadata_generated") == F.lit(False))
