"""Facet lists and per-source counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_sources(df: DataFrame) -> DataFrame:
    """Non-NULL sources, ordered. Partial aggregation collapses each source
    map-side, so a hot source costs one row per map task."""
    return (df.filter(F.col("source").isNotNull())
              .select("source").distinct()
              .orderBy("source"))


def distinct_tags(df: DataFrame) -> DataFrame:
    """Every distinct tag, ascending with NULL last (a NULL element survives
    as one row)."""
    return (df.filter(F.col("tags").isNotNull())
              .select(F.explode("tags").alias("tag"))
              .distinct()
              .orderBy(F.col("tag").asc_nulls_last()))


def source_counts(df: DataFrame, order_by: str = "count") -> DataFrame:
    """Rows per source. ``order_by='count'``: count descending, source as
    tie-break; ``'source'``: by source."""
    out = df.groupBy("source").agg(F.count(F.lit(1)).alias("count"))
    if order_by == "count":
        return out.orderBy(F.col("count").desc(), F.col("source").asc_nulls_last())
    if order_by == "source":
        return out.orderBy(F.col("source").asc_nulls_last())
    raise ValueError("order_by must be 'count' or 'source'")


def source_counts_with_total(df: DataFrame) -> DataFrame:
    """Per-source counts plus a grand-total row (``is_total``)."""
    return (df.rollup("source")
              .agg(F.count(F.lit(1)).alias("count"),
                   (F.grouping("source") == 1).alias("is_total")))
