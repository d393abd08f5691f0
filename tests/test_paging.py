"""Paging properties: offset pages partition the order; keyset pages equal
offset pages even with NULLs and ties."""

import datetime as dt
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.operators import paging


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id string, published_date timestamp_ntz, created_at timestamp_ntz")


def _rows(seed, n):
    r = random.Random(seed)
    days = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)]
    created = [None, dt.datetime(2024, 5, 1), dt.datetime(2024, 5, 2)]
    return [(f"id{i:03d}", r.choice(days), r.choice(created)) for i in range(n)]


@settings(max_examples=6, deadline=None)
@given(seed=st.integers(0, 10_000), n=st.integers(0, 60), size=st.integers(1, 25))
def test_keyset_equals_offset(spark, seed, n, size):
    df = _frame(spark, _rows(seed, n))
    keys = paging.listing_keys()
    full = [r.id for r in paging.order(df, keys).collect()]
    offset_pages, keyset_pages = [], []
    cursor = None
    for off in range(0, n + size, size):
        offset_pages += [r.id for r in paging.page(df, size, off, keys, position=False).collect()]
        pg = paging.keyset_page(df, cursor, size, keys)
        got = pg.collect()
        keyset_pages += [r.id for r in got]
        if got:
            last = got[-1]
            cursor = (last.published_date, last.created_at, last.id)
    assert offset_pages == full
    assert keyset_pages == full


def test_page_meta_flags(spark):
    df = _frame(spark, _rows(1, 10))
    m = paging.page_meta(paging.page(df, 5, 5), 5, 5).first()
    assert (m.n_rows, m.has_more, m.next_offset) == (5, True, 10)
    e = paging.exact_has_more(df, 5, 5).first()
    assert (e.n_rows, e.has_more, e.next_offset) == (5, False, 10)
