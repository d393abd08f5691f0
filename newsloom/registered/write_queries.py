"""Write-path queries: contract, first-wins, insert-if-absent, keyed update."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from newsloom.checkout import sql_arr, sql_ts
from newsloom.operators import search, writes
from newsloom.registered.base import ARTICLES_CTE
from newsloom.registry import register
from newsloom.sources.tables import articles, contract_batch, event_batch

NOW = _dt.datetime(2026, 12, 1, 5, 0, 0)
_NOW_SQL = "TIMESTAMP '2026-12-01 05:00:00'"
ORDER = ["entry_ts", "entry_pos"]

BATCH_CTE = """batch AS (
  SELECT 'https://example.org/doc/' || CAST(user_id * 10 AS VARCHAR) AS url,
         concat_ws(' ', event_type, props) AS title, event_type AS source,
         ts AS entry_ts, event_id AS entry_pos
  FROM events)"""
FIRSTS_CTE = """firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY entry_ts, entry_pos) AS rn FROM batch)
  WHERE rn = 1)"""


def _sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([ARTICLES_CTE, *ctes]) + "\n" + body


_FIRST_COLS = f"url, title, source, {sql_ts('entry_ts')} AS entry_ts, entry_pos"


@register("w1_first_per_url", _sql(f"SELECT {_FIRST_COLS} FROM firsts", BATCH_CTE, FIRSTS_CTE))
def w1_first_per_url(spark, sf):
    return writes.first_per_key(event_batch(spark, sf), "url", ORDER)


@register("s4_insert_if_absent", _sql(
    f"SELECT {_FIRST_COLS} FROM firsts f "
    "WHERE NOT EXISTS (SELECT 1 FROM articles a WHERE a.url = f.url)", BATCH_CTE, FIRSTS_CTE))
def s4_insert_if_absent(spark, sf):
    return writes.insert_if_absent(articles(spark, sf), event_batch(spark, sf), "url", order=ORDER)


@register("a8_collect_outcomes", _sql(
    "SELECT CASE WHEN f.url IS NOT NULL AND NOT EXISTS (SELECT 1 FROM articles a WHERE a.url = b.url)"
    " THEN 'inserted' ELSE 'conflict' END AS outcome, count(*) AS count "
    "FROM batch b LEFT JOIN firsts f ON f.url = b.url AND f.entry_ts = b.entry_ts "
    "AND f.entry_pos = b.entry_pos GROUP BY 1", BATCH_CTE, FIRSTS_CTE))
def a8_collect_outcomes(spark, sf):
    labelled = writes.insert_outcomes(articles(spark, sf), event_batch(spark, sf), "url", order=ORDER)
    return writes.outcome_counts(labelled)


_REASON_SQL = """CASE
  WHEN title IS NULL THEN 'title_missing'
  WHEN url IS NULL OR url = '' THEN 'url_missing'
  WHEN source IS NULL THEN 'source_missing'
  WHEN length(title) > 500 THEN 'title_too_long'
  WHEN length(source) > 200 THEN 'source_too_long' END"""
_CANDIDATES_CTE = ("cand AS (SELECT id, split_part(content, chr(10), 1) AS title, url, source "
                   "FROM articles)")


@register("s7_row_contract", _sql(f"SELECT id, {_REASON_SQL} AS reason FROM cand", _CANDIDATES_CTE))
def s7_row_contract(spark, sf):
    ok, bad = writes.apply_contract(contract_batch(spark, sf), NOW)
    return ok.select("id", F.lit(None).cast("string").alias("reason")).unionByName(
        bad.select("id", "reason"))


@register("s7_accepted_defaults", _sql(
    f"SELECT url, sha256(url) AS new_id, {sql_ts(_NOW_SQL)} AS created_at, false AS metadata_generated "
    f"FROM cand WHERE ({_REASON_SQL}) IS NULL", _CANDIDATES_CTE))
def s7_accepted_defaults(spark, sf):
    batch = contract_batch(spark, sf).drop("id")
    ok, _ = writes.apply_contract(batch, NOW)
    return ok.select("url", F.col("id").alias("new_id"), "created_at", "metadata_generated")


def _updates(a):
    """Updates for every pending article: the title as summary and its long
    words as tags (possibly an empty list)."""
    return search.pending(a).select(
        "id",
        F.col("title").alias("summary"),
        F.filter(F.split("title", " "), lambda w: F.char_length(w) > 3).alias("tags"))


@register("s5_duplicate_updates", _sql(
    "SELECT a.id, CASE WHEN a.metadata_generated THEN a.summary ELSE 'first' END AS summary, "
    f"{sql_ts(f'CASE WHEN a.metadata_generated THEN a.updated_at ELSE {_NOW_SQL} END')} AS updated_at FROM articles a"))
def s5_duplicate_updates(spark, sf):
    """Three updates for every pending id: the first in order counts and no
    row is multiplied."""
    a = articles(spark, sf)
    u = search.pending(a).select("id", F.explode(F.array(F.lit("second"), F.lit("first"), F.lit("third"))).alias("summary"))
    u = u.withColumn("pos", F.when(F.col("summary") == "first", 0).when(F.col("summary") == "second", 1).otherwise(2))
    return writes.update_by_key(a, u, "id", NOW, order=["pos"]).select("id", "summary", "updated_at")


@register("s5_keyed_update", _sql(
    f"SELECT a.id, CASE WHEN u.id IS NOT NULL THEN u.summary ELSE a.summary END AS summary, "
    f"{sql_arr('CASE WHEN u.id IS NOT NULL THEN u.tags ELSE a.tags END')} AS tags, "
    f"{sql_ts(f'CASE WHEN u.id IS NOT NULL THEN {_NOW_SQL} ELSE a.updated_at END')} AS updated_at, "
    "CASE WHEN u.id IS NOT NULL THEN true ELSE a.metadata_generated END AS metadata_generated "
    "FROM articles a LEFT JOIN upd u ON u.id = a.id",
    "upd AS (SELECT id, title AS summary, "
    "list_filter(string_split(title, ' '), lambda w: length(w) > 3) AS tags "
    "FROM articles WHERE metadata_generated = false)"))
def s5_keyed_update(spark, sf):
    a = articles(spark, sf)
    out = writes.update_by_key(a, _updates(a), "id", NOW)
    return out.select("id", "summary", "tags", "updated_at", "metadata_generated")
