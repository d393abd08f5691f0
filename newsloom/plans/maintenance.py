"""Source maintenance pipelines: ordered normalisation and duplicate clean-up.

Every number they report is a function of one per-source count, so the table
is scanned once for all of them and the rules are then applied to the
distinct source names.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators import facets, rules as R
from newsloom.session import cut_lineage


@dataclass
class CleanupResult:
    preview: DataFrame          # count per listed source, ordered by source
    preview_total: int
    table: DataFrame            # table after the delete (input if nothing to do)
    deleted: int
    after: DataFrame            # count per source after the delete


def delete_preview(df: DataFrame, sources=R.CLEANUP_SOURCES) -> DataFrame:
    return facets.source_counts(df.filter(F.col("source").isin(list(sources))), "source")


def source_histogram(df: DataFrame) -> DataFrame:
    """(source, count) of the table, NULL included, written down once."""
    return cut_lineage(df.groupBy("source").agg(F.count(F.lit(1)).alias("count")))


def _sorted(counts: DataFrame) -> DataFrame:
    return counts.select("source", "count").orderBy(F.col("source").asc_nulls_last())


def cleanup(df: DataFrame, sources=R.CLEANUP_SOURCES) -> CleanupResult:
    """Preview the listed sources; delete them only if the preview found
    rows; recount. One scan counts the sources; one number reaches the
    driver."""
    counts = source_histogram(df)
    listed = F.coalesce(F.col("source").isin(list(sources)), F.lit(False))
    total = int(counts.filter(listed).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("t")).first()["t"])
    kept = df.filter(~listed) if total else df
    return CleanupResult(_sorted(counts.filter(listed)), total, kept, total, _sorted(counts.filter(~listed)))


def rule_set(name: str) -> tuple[tuple, tuple]:
    """(rules, deleted sources): ``default`` deletes the unwanted sources
    first; ``sql`` is the script variant without delete."""
    if name == "default":
        return R.DEFAULT_RULES, R.DEFAULT_DELETE
    if name == "sql":
        return R.SQL_VARIANT_RULES, ()
    raise ValueError("rule_set must be 'default' or 'sql'")


def normalise(df: DataFrame, rule_set_name: str = "default",
              now: _dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Ordered normalisation with the named rule set: the new table and the
    rows affected per step. The steps are counted on the source histogram."""
    rules, delete = rule_set(rule_set_name)
    table = R.apply_flags(R.flag_rules(df, rules, delete), now)
    return table, R.step_counts(R.flag_rules(source_histogram(df), rules, delete), rules, delete, weight="count")


@dataclass
class NormaliseRun:
    before: DataFrame   # (source, count) ordered by source
    steps: DataFrame    # rows affected per step
    after: DataFrame    # (source, count) ordered by source


def run_normalise(store, rule_set_name: str, now: _dt.datetime) -> NormaliseRun:
    """Normalise the stored table: histogram, delete and rules, histogram.
    One scan counts, one rewrites."""
    rules, delete = rule_set(rule_set_name)
    counts = source_histogram(store.read())
    flagged = R.flag_rules(counts, rules, delete)
    steps = cut_lineage(R.step_counts(flagged, rules, delete, weight="count"))
    after = flagged.filter(~F.col("_del")).groupBy(F.col("_new").alias("source")).agg(F.sum("count").alias("count"))
    store.replace(R.apply_flags(R.flag_rules(store.read(), rules, delete), now))
    return NormaliseRun(_sorted(counts), steps, _sorted(after))


def run_cleanup(store, sources=R.CLEANUP_SOURCES) -> CleanupResult:
    """Delete the listed sources from the stored table, if it has any."""
    res = cleanup(store.read(), sources)
    if res.deleted:
        store.replace(res.table)
    return res
