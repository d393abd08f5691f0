"""Row shapes: full article, list card, detail view, enrich worklist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions import display as D
from newsloom.schema import ARTICLE_COLUMNS


def article_row(df: DataFrame) -> DataFrame:
    return df.select(*ARTICLE_COLUMNS)


def card_view(df: DataFrame, locale: str = "ja", fallback: str = D.NO_SUMMARY,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """What a list card shows; ``content`` is pruned so it never reaches a
    sort or a shuffle."""
    return df.select(
        "id", "title", "url", "source", "image_url",
        D.summary_or("summary", fallback).alias("summary_text"),
        D.first_tags("tags").alias("card_tags"),
        D.card_date("published_date", locale).alias("date_text"),
        *keep,
    )


def detail_view(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "title", "url", "source", "image_url", "tags",
        D.detail_date("published_date").alias("date_text"),
        D.non_empty("summary").alias("summary"),
        D.non_empty("content").alias("content"),
    )


def worklist_row(df: DataFrame) -> DataFrame:
    return df.select("id", "title", "url", "content")
