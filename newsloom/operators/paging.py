"""Listing order, offset paging, keyset paging and the page envelope."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.times import ntz


@dataclass(frozen=True)
class Key:
    col: str
    ascending: bool
    nulls_first: bool

    def sort(self) -> Column:
        c = F.col(self.col)
        if self.ascending:
            return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()


def listing_keys(direction: str = "desc") -> list[Key]:
    """Newest first with undated rows last; then newest insert first (NULL
    first, as the reference database orders DESC); ``id`` makes the order
    total so pages never overlap or skip."""
    if direction not in ("desc", "asc"):
        raise ValueError("direction must be 'asc' or 'desc'")
    return [Key("published_date", direction == "asc", False),
            Key("created_at", False, True),
            Key("id", True, False)]


def worklist_keys() -> list[Key]:
    return [Key("created_at", False, True), Key("id", True, False)]


def order(df: DataFrame, keys: list[Key]) -> DataFrame:
    return df.orderBy(*[k.sort() for k in keys])


def with_position(page_df: DataFrame, keys: list[Key], offset: int) -> DataFrame:
    """1-based position of each row of an already-limited page. The window
    runs over at most ``limit`` rows."""
    w = Window.orderBy(*[k.sort() for k in keys])
    return page_df.withColumn("pos", F.row_number().over(w) + F.lit(offset))


def page(df: DataFrame, limit: int = 100, offset: int = 0,
         keys: list[Key] | None = None, position: bool = True) -> DataFrame:
    """``ORDER BY keys LIMIT limit OFFSET offset``.

    The top-(offset+limit) per partition and its merge run over the key
    columns only; the page's rows are then fetched by ``id`` (unique), so
    wide columns such as ``content`` never pass through the merging task."""
    if limit < 0 or offset < 0:
        raise ValueError("limit and offset must be non-negative")
    keys = keys or listing_keys()
    top = _cut(df.select(*[k.col for k in keys]), keys, limit, offset)
    return _fetch(df, with_position(top, keys, offset), position)


def _cut(narrow: DataFrame, keys: list[Key], limit: int, offset: int = 0) -> DataFrame:
    out = order(narrow, keys)
    return (out.offset(offset) if offset else out).limit(limit)


def _fetch(df: DataFrame, placed: DataFrame, position: bool) -> DataFrame:
    """Rows of ``df`` whose ``id`` is on the page, in page order."""
    out = df.join(placed.select("id", "pos"), "id").select(*df.columns, "pos").orderBy("pos")
    return out if position else out.drop("pos")


def _lit(v) -> Column:
    """A cursor value; datetimes as zone-free timestamps."""
    return ntz(v) if isinstance(v, _dt.datetime) else F.lit(v)


def _later(k: Key, last) -> Column:
    c = F.col(k.col)
    if last is None:
        # NULL sorts last: nothing is strictly after it; NULL first: every value is.
        return c.isNotNull() if k.nulls_first else F.lit(False)
    after = (c > _lit(last)) if k.ascending else (c < _lit(last))
    # Plain comparisons only, so that the whole filter can be pushed; a NULL
    # comparison is no match, as in any filter.
    return after if k.nulls_first else (c.isNull() | after)


def after_cursor(keys: list[Key], cursor: tuple) -> Column:
    """Rows strictly after ``cursor`` (values of the keys of the last row seen)
    in the order given by ``keys``, with explicit NULL branches."""
    if len(cursor) != len(keys):
        raise ValueError("cursor needs one value per key")
    pairs = list(zip(keys, cursor))

    def build(i: int) -> Column:
        k, v = pairs[i]
        later = _later(k, v)
        if i == len(pairs) - 1:
            return later
        same = F.col(k.col).isNull() if v is None else F.col(k.col) == _lit(v)
        return later | (same & build(i + 1))

    return bound(pairs[0][0], pairs[0][1]) & build(0)


def bound(k: Key, last) -> Column:
    """What every row after the cursor fulfils on the first key alone: a plain
    comparison that is pushed down to the scan, so row groups before the
    cursor are skipped."""
    c = F.col(k.col)
    if last is None:
        return F.lit(True) if k.nulls_first else c.isNull()
    at = (c >= _lit(last)) if k.ascending else (c <= _lit(last))
    return at if k.nulls_first else (at | c.isNull())


def keyset_page(df: DataFrame, cursor: tuple | None, limit: int = 100,
                keys: list[Key] | None = None) -> DataFrame:
    """Next page after ``cursor``. The first key's bound is pushed to the
    scan; keys only go through the top-k, as in :func:`page`."""
    keys = keys or listing_keys()
    if cursor is not None:
        df = df.filter(after_cursor(keys, cursor))
    top = _cut(df.select(*[k.col for k in keys]), keys, limit)
    return _fetch(df, with_position(top, keys, 0), False)


def cursor_of(page_df: DataFrame, keys: list[Key] | None = None) -> tuple | None:
    """Key values of the last row of a page (one row reaches the driver)."""
    keys = keys or listing_keys()
    rows = order(page_df.select(*[k.col for k in keys]),
                 [Key(k.col, not k.ascending, not k.nulls_first) for k in keys]).take(1)
    return tuple(rows[0]) if rows else None


def page_meta(page_df: DataFrame, limit: int, offset: int) -> DataFrame:
    """One-row envelope: ``has_more`` is ``count == limit`` (as the reference
    API reports it), ``next_offset`` is ``offset + count``."""
    n = F.count(F.lit(1))
    return page_df.agg(
        n.alias("n_rows"),
        (n == F.lit(limit)).alias("has_more"),
        (F.lit(offset) + n).alias("next_offset"),
    )


def exact_has_more(df: DataFrame, limit: int, offset: int,
                   keys: list[Key] | None = None) -> DataFrame:
    """Exact variant: reads ``limit + 1`` rows, so a full last page says no."""
    keys = keys or listing_keys()
    probe = _cut(df.select(*[k.col for k in keys]), keys, limit + 1, offset)
    n = F.count(F.lit(1))
    return probe.agg(
        F.least(n, F.lit(limit)).alias("n_rows"),
        (n > F.lit(limit)).alias("has_more"),
        (F.lit(offset) + F.least(n, F.lit(limit))).alias("next_offset"),
    )
