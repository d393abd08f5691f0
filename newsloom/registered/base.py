"""Shared pieces of the registered queries: the article adapter in DuckDB SQL
(mirror of :func:`newsloom.sources.tables.articles`)."""

from __future__ import annotations

from newsloom.checkout import sql_arr, sql_ts

ARTICLES_CTE = """
articles AS (
  SELECT
    'a-' || lpad(CAST(d.doc_id AS VARCHAR), 12, '0') AS id,
    split_part(d.text, chr(10), 1) AS title,
    coalesce(p.url, 'https://example.org/doc/' || CAST(d.doc_id AS VARCHAR)) AS url,
    d.source AS source,
    CASE WHEN d.doc_id % 3 = 0 THEN NULL
         ELSE 'https://img.example.org/' || CAST(d.doc_id AS VARCHAR) || '.png' END AS image_url,
    d.text AS content,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL
         ELSE CAST(DATE '2024-01-01' + CAST(d.doc_id % 30 AS INTEGER) AS TIMESTAMP) END AS published_date,
    CASE WHEN l.doc_id IS NOT NULL THEN d.text END AS summary,
    CASE WHEN l.doc_id IS NOT NULL
         THEN string_split(split_part(d.text, chr(10), 1), ' ') END AS tags,
    e.ts AS created_at,
    e.ts AS updated_at,
    l.doc_id IS NOT NULL AS metadata_generated
  FROM documents d
  LEFT JOIN pages p ON p.page_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
  LEFT JOIN events e ON e.event_id = d.doc_id
)"""

ROW_COLS_SQL = (
    "id, title, url, source, image_url, content, "
    f"{sql_ts('published_date')} AS published_date, summary, {sql_arr('tags')} AS tags, "
    f"{sql_ts('created_at')} AS created_at, {sql_ts('updated_at')} AS updated_at, "
    "metadata_generated"
)

LISTING_ORDER_SQL = "published_date DESC NULLS LAST, created_at DESC NULLS FIRST, id ASC"
LISTING_ORDER_ASC_SQL = "published_date ASC NULLS LAST, created_at DESC NULLS FIRST, id ASC"


def with_articles(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join([ARTICLES_CTE, *extra_ctes])
    return f"WITH {ctes}\n{body}"


def tag_hit_sql(pattern: str, tags: str = "tags") -> str:
    """Some element of ``tags`` ILIKE ``pattern`` (FALSE for NULL arrays)."""
    return (f"EXISTS (SELECT 1 FROM unnest({tags}) AS u(t) "
            f"WHERE t ILIKE '{pattern}' ESCAPE '\\')")


def title_hit_sql(pattern: str) -> str:
    return f"coalesce(title ILIKE '{pattern}' ESCAPE '\\', false)"
