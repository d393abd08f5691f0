"""The article table and the other fixed shapes the engine exchanges."""

from __future__ import annotations

from pyspark.sql import types as T

# One row per article. ``id`` is a string (Spark has no UUID type); the writers
# derive it from the url so reruns produce the same id.
ARTICLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("url", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField("image_url", T.StringType(), True),
    T.StructField("content", T.StringType(), True),
    T.StructField("published_date", T.TimestampNTZType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("tags", T.ArrayType(T.StringType()), True),
    T.StructField("created_at", T.TimestampNTZType(), True),
    T.StructField("updated_at", T.TimestampNTZType(), True),
    T.StructField("metadata_generated", T.BooleanType(), True),
])

ARTICLE_COLUMNS = [f.name for f in ARTICLE_SCHEMA.fields]

# Landed page fetches: one row per url.
PAGE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType(), False),
    T.StructField("html", T.StringType(), True),
    T.StructField("http_status", T.IntegerType(), True),
    T.StructField("fetch_error", T.StringType(), True),
    T.StructField("fetched_at", T.TimestampNTZType(), True),
])

# Fixed limits of the article row contract.
TITLE_MAX_CHARS = 500
SOURCE_MAX_CHARS = 200

# Outcome labels of the collect and enrich runs.
OUTCOME_INSERTED = "inserted"
OUTCOME_CONFLICT = "conflict"
OUTCOME_REJECTED = "rejected"
OUTCOME_UNREACHABLE = "unreachable"
OUTCOME_NO_LINK = "no_link"
OUTCOME_UPDATED = "updated"
OUTCOME_SKIPPED = "skipped"
